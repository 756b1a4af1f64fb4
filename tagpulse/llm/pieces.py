"""Piece ids of texts and texts of piece ids, for merge-type SentencePiece vocabularies."""

import codecs
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"  # stands for a space within pieces
#: Spaces and what follows them of one kind: letters, digits or other characters.
_OTHER = rf"(?:[_¹²³]|[^\w{SPACE}])"
_CHUNKS = re.compile(rf"{SPACE}*[^\W\d_¹²³]+|{SPACE}*\d+|{SPACE}*{_OTHER}+|{SPACE}+")
SHORT = 64  # characters; longer chunks are seldom met twice, and are merged one by one
BATCH_CHARS = 1 << 21

codecs.register_error("tagpulse_each_byte", lambda error: ("�", error.start + 1))


def agenda(symbols: list[str], scores: dict[str, float]) -> list[str]:
    """Merges adjacent symbols, the pair of the highest score first and of equal ones the leftmost, until no pair is in `scores`.

    The agenda is a heap of adjacent pairs. A pair of which one side has been merged since is stale, which its length
    tells. n symbols take about n·log n steps.
    """
    symbols = list(symbols)
    count = len(symbols)
    after, earlier = list(range(1, count + 1)), list(range(-1, count - 1))
    pairs = []

    def pair(left, right):
        joined = symbols[left] + symbols[right]
        score = scores.get(joined)
        return None if score is None else (-score, left, right, joined)

    for left in range(count - 1):
        entry = pair(left, left + 1)
        if entry:
            pairs.append(entry)
    heapify(pairs)
    while pairs:
        _, left, right, joined = heappop(pairs)
        a, b = symbols[left], symbols[right]
        if not a or not b or len(a) + len(b) != len(joined):
            continue
        symbols[left], symbols[right] = joined, ""
        beyond, before = after[right], earlier[left]
        after[left] = beyond
        if beyond < count:
            earlier[beyond] = left
        for entry in (beyond < count and pair(left, beyond), before >= 0 and pair(before, left)):
            if entry:
                heappush(pairs, entry)
    return [s for s in symbols if s]


class Merges:
    """The same agenda for many short chunks at once: in every round each chunk merges its pair of the highest score."""

    def __init__(self, ids: dict[str, int], scores: dict[str, float]):
        single = sorted({c for p in ids for c in p} - set(ids))  # characters that are only part of pieces
        self.symbols = ids | {c: len(ids) + max(ids.values()) + k for k, c in enumerate(single, 1)}
        self.of_char = -1 - np.arange(0x110000, dtype=np.int64)  # a character without a symbol never merges
        for c, n in self.symbols.items():
            if len(c) == 1:
                self.of_char[ord(c)] = n
        self.chars = {n: c for c, n in self.symbols.items() if c in single}
        self.base = max(self.symbols.values()) + 1
        rank = {s: n for n, s in enumerate(sorted(set(scores.values())))}
        table = sorted(
            (self.symbols[p[:k]] * self.base + self.symbols[p[k:]], rank[scores[p]], n)
            for p, n in ids.items() for k in range(1, len(p)) if p[:k] in self.symbols and p[k:] in self.symbols)
        self.keys, self.ranks, self.merged = (np.array(column, np.int64) for column in (zip(*table) if table else ((-1,),) * 3))

    def _pairs(self, left: np.ndarray, right: np.ndarray):
        """Rank (-1: no such piece) and symbol of the piece that each pair makes."""
        key = np.where((left < 0) | (right < 0), -1, left * self.base + right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1), self.merged[at]

    def run(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all chunks, one after the other, and how many each has; -1 - c is a character of no piece."""
        sizes = np.array([len(c) for c in chunks], np.int64)
        symbol = self.of_char[np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)]
        owner = np.repeat(np.arange(len(chunks)), sizes)
        ends = np.cumsum(sizes) - 1
        rank, piece = self._pairs(symbol, np.append(symbol[1:], -1))
        rank[ends] = -1
        done = []
        while len(sizes):
            starts = np.append(0, np.cumsum(sizes)[:-1])
            best = np.maximum.reduceat(rank, starts)
            over = best < 0
            if over.any():
                gone = np.repeat(over, sizes)
                done.append((owner[gone], symbol[gone]))
                symbol, owner, rank, piece = symbol[~gone], owner[~gone], rank[~gone], piece[~gone]
                sizes, best = sizes[~over], best[~over]
                if not len(sizes):
                    break
                starts = np.append(0, np.cumsum(sizes)[:-1])
            hits = np.flatnonzero(rank == np.repeat(best, sizes))
            left = hits[np.append(True, owner[hits[1:]] != owner[hits[:-1]])]  # one for each chunk, in order
            symbol[left] = piece[left]
            stay = np.ones(len(symbol), bool)
            stay[left + 1] = False
            symbol, owner, rank, piece = symbol[stay], owner[stay], rank[stay], piece[stay]
            at = left - np.arange(len(left))  # every chunk before has lost one symbol
            sizes -= 1
            starts = np.append(0, np.cumsum(sizes)[:-1])
            last = at == starts + sizes - 1
            rank[at[last]] = -1
            for of in (at[~last], at[at > starts] - 1):
                rank[of], piece[of] = self._pairs(symbol[of], symbol[of + 1])
        owners = np.concatenate([o for o, _ in done]) if done else np.zeros(0, np.int64)
        symbols = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int64)
        return symbols[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(chunks))


class PieceTokens:
    """Encodes and decodes by a merge-type model file of the `sentencepiece` library with an identity normaliser.

    No piece of such a vocabulary has a space after another character or joins letters, digits and other characters, so no
    merge crosses from one to the other: a text falls into chunks there that merge on their own, and equal chunks have
    equal ids. Every chunk that is merged is also held against the library, ids and decoded text.
    """

    def __init__(self, path: str, cached_chunks: int = 1 << 19):
        from sentencepiece import SentencePieceProcessor

        self.library = library = SentencePieceProcessor(model_file=path)
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self._byte = np.full(256, -1, np.int64)
        self._silent, self._spaced = set(), set()
        parts = []
        for k in range(library.get_piece_size()):
            piece = library.id_to_piece(k)
            if library.is_control(k):
                self._silent.add(k)
                parts.append(b"")
            elif library.is_unknown(k):
                parts.append(" ⁇ ".encode())  # fixed value: what the library writes for it
            elif library.is_byte(k):
                self._byte[int(piece[3:5], 16)] = k
                parts.append(bytes([int(piece[3:5], 16)]))
            else:
                self.scores[piece], self.ids[piece] = library.get_score(k), k
                parts.append(piece.replace(SPACE, " ").encode())
                if piece[0] == SPACE:
                    self._spaced.add(k)
        probe = "  ﬁ x "
        if (min(self._byte) < 0 or library.normalize(probe) != SPACE + probe.replace(" ", SPACE)
                or not all(_CHUNKS.fullmatch(p) for p in self.ids)):
            raise ValueError(f"{path}: needs byte pieces, identity normalisation, and pieces of spaces and one kind of characters")
        self.entries = parts  # the bytes that each id stands for
        #: The same one after the other, where each begins, and its length.
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self._merges = Merges(self.ids, self.scores)
        self._inside = {p[k: k + 2] for p in self.ids for k in range(len(p) - 1)}
        self._known: dict[str, bytes] = {}
        self._limit = cached_chunks

    def _written(self, symbols: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The ids of each chunk as little-endian int32; the bytes of a character that is no piece have ids of their own."""
        ends = np.cumsum(counts)
        odd = np.flatnonzero((symbols < 0) | (symbols >= len(self.sizes)))
        if not len(odd):
            line = symbols.astype("<i4").tobytes()
            return [line[4 * (e - c): 4 * e] for e, c in zip(ends.tolist(), counts.tolist())]
        wide = symbols.tolist()
        found = []
        for end, count in zip(ends.tolist(), counts.tolist()):
            ids = []
            for s in wide[end - count: end]:
                if 0 <= s < len(self.sizes):
                    ids.append(s)
                else:
                    char = chr(-1 - s) if s < 0 else self._merges.chars[s]
                    ids.extend(self._byte[list(char.encode())].tolist())
            found.append(np.array(ids, "<i4").tobytes())
        return found

    def _long(self, chunk: str) -> bytes:
        # two characters that no piece has side by side are never merged, so each stretch between such has its own agenda
        cuts = [at for at in range(1, len(chunk)) if chunk[at - 1: at + 1] not in self._inside]
        symbols = [
            self.ids.get(s, -1 - ord(s[0]))
            for a, b in zip([0, *cuts], [*cuts, len(chunk)]) for s in agenda(chunk[a:b], self.scores)]
        return self._written(np.array(symbols, np.int64), np.array([len(symbols)]))[0]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts (little-endian int32), as the library gives them without begin and end ids; an empty text has none.

        Chunks met for the first time are compared with the library; a difference raises ValueError.
        """
        cut = [_CHUNKS.findall(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        chunks = set().union(*cut)
        if len(self._known) + len(chunks) > self._limit:
            self._known = {}
        new = list(chunks.difference(self._known))
        short = [c for c in new if len(c) <= SHORT]
        found = dict(zip(short, self._written(*self._merges.run(short)))) if short else {}
        found.update((c, self._long(c)) for c in new if len(c) > SHORT)
        if found:
            self._check(found)
        self._known.update(found)
        encoded = [b"".join(map(self._known.__getitem__, c)) for c in cut]
        for chunk in new:
            if len(chunk) > SHORT:
                del self._known[chunk]
        return encoded

    def _check(self, found: dict[str, bytes]) -> None:
        """Lets the library encode and decode all chunks as one text, in which each begins where the kind of character changes."""
        spaces = [c for c in found if not c.strip(SPACE)]  # these only end texts
        joined = [c for c in found if c.strip(SPACE)]
        before = ["" if c[0] == SPACE else f"{SPACE}a" if re.match(_OTHER, c) else f"{SPACE}," for c in joined]
        lead = {w: b"".join(self._long(c) for c in _CHUNKS.findall(w)) for w in ("", f"{SPACE}a", f"{SPACE},")}
        text = f"{SPACE}a" + "".join(w + c for w, c in zip(before, joined))
        ours = lead[f"{SPACE}a"] + b"".join(lead[w] + found[c] for w, c in zip(before, joined))
        theirs = self.library.encode(text[1:], out_type="numpy", num_threads=1)
        same = theirs.astype("<i4").tobytes() == ours and self.library.decode(theirs) == self.decode(ours)
        if not same or not all(self._agrees(c, found[c]) for c in spaces):
            raise ValueError(f"the library encodes otherwise: {[c for c in found if not self._agrees(c, found[c])][:3]!r}")

    def _agrees(self, chunk: str, ids: bytes) -> bool:
        lead = "a" if chunk[0] == SPACE or re.match(_OTHER, chunk) else ","
        return np.array(self.library.encode(lead + chunk.replace(SPACE, " ")), "<i4").tobytes().endswith(ids)

    def decode(self, ids: bytes) -> str:
        """The text of ids (little-endian int32), as the library gives it: without the space that it puts before a text, and
        with U+FFFD for every byte that is no UTF-8."""
        number = np.frombuffer(ids, "<i4")
        if not len(number):
            return ""
        runs = [number]
        silent = np.isin(number, list(self._silent))
        if silent.any():  # bytes on the two sides of a control piece don't make a character
            runs = [r for r in np.split(number, np.flatnonzero(silent)) if len(r)]
        text = "".join(self._bytes(r).tobytes().decode("utf-8", "tagpulse_each_byte") for r in runs)
        first = number[np.argmin(silent)]
        return text[1:] if int(first) in self._spaced else text

    def _bytes(self, number: np.ndarray) -> np.ndarray:
        sizes = self.sizes[number]
        ends = np.cumsum(sizes)
        return self.bytes[np.repeat(self.starts[number] - ends + sizes, sizes) + np.arange(ends[-1])]


def by_size(batch: pa.RecordBatch, chars: int = BATCH_CHARS) -> Iterator[tuple[int, list[str]]]:
    """The texts of the second column in slices of about `chars` characters, with the place of the first; a NULL is empty."""
    texts, begin, size = [], 0, 0
    for place, text in enumerate(batch.column(1)):
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= chars:
            yield begin, texts
            texts, begin, size = [], place + 1, 0
    if texts:
        yield begin, texts


def encode(docs: DataFrame, model: str, decoded: bool = False) -> DataFrame:
    """Every text of `docs` (`doc_id`, `text`) as piece ids of `model`, a file that every executor can read.

    Per row: doc_id, ids (array<int>, without begin and end ids) and, with `decoded`, the text that these ids stand for. One
    pass in Arrow batches, no shuffle. Every distinct chunk that a task meets is compared with the library, batch by batch;
    a difference fails the query.
    A NULL or empty text has no ids and decodes to an empty one; a NULL doc_id is kept; repeated rows come out as often;
    an empty table gives no rows; other columns are ignored. Long texts are taken whole: time grows with n·log n of the
    longest run of letters, memory with the longest text.
    """
    schema = "doc_id long, ids array<int>" + (", decoded string" if decoded else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = PieceTokens(model)
        for batch in batches:
            for begin, texts in by_size(batch):
                lists = tokens.encode(texts)
                ends = np.cumsum([0, *(len(ids) // 4 for ids in lists)]).astype(np.int32)
                values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(lists))])
                columns = {"doc_id": batch.column(0).slice(begin, len(texts)), "ids": pa.ListArray.from_arrays(pa.array(ends), values)}
                if decoded:
                    columns["decoded"] = pa.array([tokens.decode(ids) for ids in lists], pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def decode(rows: DataFrame, model: str) -> DataFrame:
    """The texts (`doc_id`, `decoded`) of ids (`doc_id`, `ids`: array<int>), as the library decodes them.

    NULL or no ids give an empty text, a NULL among ids is passed over, an id outside the vocabulary fails the query.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = PieceTokens(model)
        for batch in batches:
            lines = []
            for ids in batch.column(1):
                number = np.array([k for k in ids.as_py() or () if k is not None], "<i4")
                if len(number) and not (0 <= number.min() and number.max() < len(tokens.sizes)):
                    raise ValueError("an id outside the vocabulary")
                lines.append(tokens.decode(number.tobytes()))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "decoded": pa.array(lines, pa.string())})

    return rows.select(rows["doc_id"].cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, decoded string")

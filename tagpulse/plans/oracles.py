"""The registered queries as plain SQL over the whole test tables, for a check by another engine."""

from tagpulse.functions.text import TOKEN
from tagpulse.plans.queries import COUNTRY_PART, TAGS, USER_PART

TAG_LIST = ", ".join(f"'{t}'" for t in TAGS)

# posts: one row each, with the two hashtags h0 and h1
DOCS = """
docs AS (
  SELECT doc_id AS tweet_id, 1704067200000000 + doc_id * 7000000 AS us, text, lang,
         'u' || (doc_id % 50) AS user_name, CASE WHEN lang <> 'fr' THEN n_name END AS country,
         CASE WHEN doc_id % 2 = 0 THEN upper(source) ELSE source END AS h0, lang AS h1,
         length(text) - length(replace(text, ' ', '')) + 1 AS words
  FROM documents LEFT JOIN nation ON n_nationkey = doc_id % 25)"""
EVENTS = """
evs AS (
  SELECT event_id AS tweet_id, epoch_us(ts) AS us,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) >= 50 THEN 'en' ELSE 'de' END AS lang,
         'u' || user_id AS user_name, CASE WHEN event_type <> 'error' THEN n_name END AS country,
         event_type AS h0, 'src' || (user_id % 30) AS h1
  FROM events LEFT JOIN nation ON n_nationkey = user_id % 25)"""
# one row per hashtag
DOC_TAGS = DOCS + """,
dt AS (
  SELECT *, 0 AS tag_pos, lower(h0) AS tag, h0 AS raw_tag FROM docs
  UNION ALL SELECT *, 1, lower(h1), h1 FROM docs)"""
EVENT_TAGS = EVENTS + """,
et AS (
  SELECT *, 0 AS tag_pos, lower(h0) AS tag FROM evs UNION ALL SELECT *, 1, lower(h1) FROM evs)"""
# tokens of each document, with their place
TOKENS = f"""
toks AS (
  SELECT doc_id AS tweet_id, unnest(w) AS word, unnest(range(len(w))) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '{TOKEN}') AS w FROM documents)),
tok_stats AS (
  SELECT tweet_id, count(*) AS tokens, max(length(word)) AS longest FROM toks GROUP BY 1),
tag_tokens AS (
  SELECT tag, CAST(sum(tokens) AS BIGINT) AS tokens, max(longest) AS longest FROM dt JOIN tok_stats USING (tweet_id) GROUP BY 1)"""
ARRIVAL = "us, tweet_id, tag_pos"


def window_s(seconds):
    return f"(us // {seconds * 1000000} * {seconds})"


def closed(seconds):
    """Windows that the stream has seen the end of: it waits a minute past the latest post."""
    return f"window_s + {seconds} <= (SELECT max(us) // 1000 * 1000 - 60000000 FROM {{posts}}) / 1000000.0"


FIT = """
model AS (
  SELECT slope, (sy - slope * sx) / n AS intercept, n AS points
  FROM (SELECT *, (n * sxy - sx * sy) / nullif(CAST(n * sxx - sx * sx AS DOUBLE), 0) AS slope
        FROM (SELECT CAST(count(*) AS HUGEINT) AS n, sum(CAST(tokens AS HUGEINT)) AS sx, sum(CAST(longest AS HUGEINT)) AS sy,
                     sum(CAST(tokens AS HUGEINT) * tokens) AS sxx, sum(CAST(tokens AS HUGEINT) * longest) AS sxy FROM tag_tokens)))"""

# lists in parts: number the items, then join those of each part
USER_PARTS = f"""
{{name}} AS (
  SELECT tag, part, string_agg(user_name, ';' ORDER BY pos) AS users
  FROM (SELECT *, (pos - 1) // {USER_PART} AS part
        FROM (SELECT tag, user_name, row_number() OVER (PARTITION BY tag ORDER BY {ARRIVAL}) AS pos
              FROM (SELECT tag, user_name, us, tweet_id, tag_pos,
                           row_number() OVER (PARTITION BY tag, user_name ORDER BY {ARRIVAL}) AS nth FROM {{rows}})
              WHERE nth = 1))
  GROUP BY 1, 2)"""
COUNTRY_PARTS = f"""
{{name}} AS (
  SELECT country, part, string_agg(tag, ';' ORDER BY pos) AS tags
  FROM (SELECT *, (pos - 1) // {COUNTRY_PART} AS part
        FROM (SELECT country, tag, row_number() OVER (PARTITION BY country ORDER BY {ARRIVAL}) AS pos
              FROM {{rows}} WHERE country IS NOT NULL))
  GROUP BY 1, 2)"""
RUNNING_USERS = f"""
firsts AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY tag, user_name ORDER BY {ARRIVAL}) = 1 THEN 1 ELSE 0 END AS is_new
  FROM et),
ru AS (
  SELECT tag, user_name, us AS ts_us, tweet_id, tag_pos, is_new,
         count(*) OVER (PARTITION BY tag ORDER BY {ARRIVAL} ROWS UNBOUNDED PRECEDING) AS uses,
         CAST(sum(is_new) OVER (PARTITION BY tag ORDER BY {ARRIVAL} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS users
  FROM firsts)"""
USER_STATES = f"""
states AS (
  SELECT tag, users, part,
         string_agg(user_name, ';') OVER (PARTITION BY tag, part ORDER BY users ROWS UNBOUNDED PRECEDING) AS text
  FROM (SELECT tag, users, user_name, (users - 1) // {USER_PART} AS part FROM ru WHERE is_new = 1))"""


def running_country(rows, ending=""):
    return f"""
rc AS (
  SELECT country, tag, us AS ts_us, tweet_id, tag_pos, position, part,
         string_agg(tag, ';') OVER (PARTITION BY country, part ORDER BY position ROWS UNBOUNDED PRECEDING) {ending} AS text
  FROM (SELECT *, (position - 1) // {COUNTRY_PART} AS part
        FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY {ARRIVAL}) AS position
              FROM {rows} WHERE country IS NOT NULL)))"""


def online(cells, order="window_s, tag"):
    """The line through all cells so far, from running sums."""
    over = f"OVER (ORDER BY {order} ROWS UNBOUNDED PRECEDING)"
    return f"""
sums AS (
  SELECT *, CAST(count(*) {over} AS HUGEINT) AS n, sum(x) {over} AS sx, sum(y) {over} AS sy,
         sum(x * x) {over} AS sxx, sum(xy) {over} AS sxy FROM {cells}),
slopes AS (
  SELECT *, CAST(n * sxy - sx * sy AS DOUBLE) / nullif(CAST(n * sxx - sx * sx AS DOUBLE), 0) AS slope FROM sums),
preds AS (
  SELECT *, (CAST(sy AS DOUBLE) - slope * CAST(sx AS DOUBLE)) / n + slope * CAST(x AS DOUBLE) AS prediction
  FROM slopes WHERE slope IS NOT NULL)"""


USER_CELLS = f"""
cells AS (
  SELECT {window_s(3600)} AS window_s, tag, count(*) AS uses, count(DISTINCT user_name) AS users FROM et GROUP BY 1, 2)"""
USER_POINTS = """
points AS (
  SELECT *, CAST(uses AS HUGEINT) AS x, CAST(users AS HUGEINT) AS y, CAST(uses * users AS HUGEINT) AS xy FROM cells {where})"""
WORD_CELLS = f"""
cells AS (
  SELECT {window_s(60)} AS window_s, tag, sum(words) AS words, count(*) AS posts FROM dt GROUP BY 1, 2),
points AS (
  SELECT window_s, tag, words / posts AS avg_words, CAST(posts AS HUGEINT) AS x,
         CAST(words AS DOUBLE) / posts AS y, CAST(words AS HUGEINT) AS xy FROM cells {{where}})"""
TAG_COUNT = "SELECT tag, count(*) AS uses FROM {rows} WHERE lang = 'en' {more} GROUP BY 1"
LONGEST = """
ranked AS (
  SELECT {key} tag, word, length(word) AS length,
         row_number() OVER (PARTITION BY {key} tag ORDER BY length(word) DESC, us, tweet_id, pos) AS nth
  FROM dt JOIN toks USING (tweet_id) WHERE {where})"""


def label(recorded, live):
    return f"'Batch-Value: ' || {recorded} || '  Stream-Value:' || {live}"


def or_none(column):
    return f"coalesce({column}, CASE WHEN part = 0 THEN 'NONE' ELSE '' END)"


def sql(*ctes, select):
    return "WITH " + ",".join(c.strip() for c in ctes) + "\n" + select


COUNTS = [DOC_TAGS, EVENT_TAGS,
          "rec AS (" + TAG_COUNT.format(rows="dt", more="AND length(text) > 0") + ")",
          "cur AS (" + TAG_COUNT.format(rows="et", more="") + ")"]
BOTH_USERS = [DOC_TAGS, EVENT_TAGS, USER_PARTS.format(name="rec", rows="dt"), USER_PARTS.format(name="cur", rows="et")]
BOTH_TAGS = [DOC_TAGS, EVENT_TAGS, COUNTRY_PARTS.format(name="rec", rows="dt"), COUNTRY_PARTS.format(name="cur", rows="et")]
RIDES = """
rides AS (
  SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate) AS row_no
  FROM lineitem {join})"""
RIDE_REST = """CAST(l_returnflag AS VARCHAR) AS c11, CAST(l_linestatus AS VARCHAR) AS c12, CAST(l_partkey AS VARCHAR) AS c13,
  CAST(l_suppkey AS VARCHAR) AS c14, CAST(l_quantity AS VARCHAR) AS c8, CAST(l_orderkey AS VARCHAR) AS c1,
  CAST(l_linenumber AS VARCHAR) AS c2"""

TAG_COUNT_EN = sql(DOC_TAGS, select=TAG_COUNT.format(rows="dt", more="AND length(text) > 0"))
AVG_COLUMNS = "CAST(sum(words) AS DOUBLE) / count(*) AS avg_words, count(*) AS posts"
TAGS_PER_COUNTRY = sql(DOC_TAGS, COUNTRY_PARTS.format(name="parts", rows="dt"), select="""
  SELECT country, part, CASE WHEN part = 0 THEN country || ':' ELSE '' END || tags || ';' AS tags FROM parts""")
USERS_PER_TAG = sql(EVENT_TAGS, USER_PARTS.format(name="parts", rows="et"), select="SELECT * FROM parts")
COMPARE_COUNT = sql(*COUNTS, select=f"""
  SELECT tag, {label("coalesce(CAST(rec.uses AS VARCHAR), 'NONE')", "cur.uses")} AS result
  FROM cur LEFT JOIN rec USING (tag)""")
COMPARE_USERS = sql(*BOTH_USERS, select=f"""
  SELECT tag, part, {label(or_none("rec.users"), "coalesce(cur.users, '')")} AS result
  FROM cur FULL JOIN rec USING (tag, part) WHERE tag IN (SELECT tag FROM cur)""")
COMPARE_TAGS = sql(*BOTH_TAGS, select=f"""
  SELECT country, part, {label(or_none("rec.tags || ';'"), "coalesce(cur.tags, '')")} AS result
  FROM cur FULL JOIN rec USING (country, part) WHERE country IN (SELECT country FROM cur)""")
# the record is the longer side: events recorded, documents live
COMPARE_USERS_TURNED = sql(
    DOC_TAGS, EVENT_TAGS, USER_PARTS.format(name="rec", rows="et"), USER_PARTS.format(name="cur", rows="dt"), select=f"""
  SELECT tag, part, {label(or_none("rec.users"), "coalesce(cur.users, '')")} AS result
  FROM cur FULL JOIN rec USING (tag, part) WHERE tag IN (SELECT tag FROM cur)""")
RAW = "SELECT user_name, text FROM docs"

ORACLES = {
    "tag_count_en": TAG_COUNT_EN,
    "tag_count_from_json": TAG_COUNT_EN,
    "users_per_tag": USERS_PER_TAG,
    "tags_per_country": TAGS_PER_COUNTRY,
    "avg_words_per_tag": sql(DOC_TAGS, select=f"""
      SELECT '"' || tag || '"' AS tag, {AVG_COLUMNS} FROM dt WHERE tag IN ({TAG_LIST}) GROUP BY tag"""),
    "avg_words_substring_match": sql(DOC_TAGS, select=f"""
      SELECT raw_tag AS tag, {AVG_COLUMNS} FROM dt WHERE contains(tag, 'src1') OR contains(tag, 'e') GROUP BY raw_tag"""),
    "longest_word_per_tag": sql(DOC_TAGS, TOKENS, LONGEST.format(key="", where=f"tag IN ({TAG_LIST})"), select="""
      SELECT tag, word, length FROM ranked WHERE nth = 1"""),
    "token_stats_per_tag": sql(DOC_TAGS, TOKENS, select="SELECT * FROM tag_tokens"),
    "regression_longest_word": sql(DOC_TAGS, TOKENS, FIT, select="""
      SELECT round(slope, 6) AS slope, round(intercept, 6) AS intercept, CAST(points AS BIGINT) AS points FROM model"""),
    "regression_longest_word_scored": sql(DOC_TAGS, TOKENS, FIT, select=f"""
      SELECT window_s, tag, tokens, longest, round(intercept + slope * tokens, 6) AS prediction
      FROM (SELECT {window_s(10)} AS window_s, tag, CAST(sum(tokens) AS BIGINT) AS tokens, max(longest) AS longest
            FROM dt JOIN tok_stats USING (tweet_id) GROUP BY 1, 2), model"""),
    "running_tag_count": sql(EVENT_TAGS, select=f"""
      SELECT tag, us AS ts_us, tweet_id, tag_pos,
             count(*) OVER (PARTITION BY tag ORDER BY {ARRIVAL} ROWS UNBOUNDED PRECEDING) AS uses
      FROM et WHERE lang = 'en'"""),
    "running_users_per_tag": sql(EVENT_TAGS, RUNNING_USERS, select="SELECT * EXCLUDE (is_new) FROM ru"),
    "running_user_lists": sql(EVENT_TAGS, RUNNING_USERS, USER_STATES, select="""
      SELECT tag, user_name, ts_us, tweet_id, tag_pos, uses, users, part, text
      FROM ru JOIN states USING (tag, users)"""),
    "running_tags_per_country": sql(
        DOC_TAGS, running_country("dt"),
        select="SELECT * REPLACE (CASE WHEN part = 0 THEN country || ':' ELSE '' END || text || ';' AS text) FROM rc"),
    "running_country_lists": sql(EVENT_TAGS, running_country("et"), select="SELECT * FROM rc"),
    "running_avg_words": sql(DOC_TAGS, select=f"""
      SELECT tag, us AS ts_us, tweet_id, tag_pos, CAST(sum(words) OVER w AS DOUBLE) / count(*) OVER w AS avg_words,
             count(*) OVER w AS posts
      FROM dt WINDOW w AS (PARTITION BY tag ORDER BY {ARRIVAL} ROWS UNBOUNDED PRECEDING)"""),
    "window_longest_word": sql(
        DOC_TAGS, TOKENS, LONGEST.format(key=f"{window_s(20)},", where="true").replace(
            f"SELECT {window_s(20)},", f"SELECT {window_s(20)} AS window_s,"),
        select="SELECT window_s, tag, word, length FROM ranked WHERE nth = 1"),
    "window_avg_words": sql(DOC_TAGS, select=f"""
      SELECT {window_s(3600)} AS window_s, tag, {AVG_COLUMNS}, CAST(sum(words) AS BIGINT) AS words, max(us) AS last_us
      FROM dt GROUP BY 1, 2"""),
    "window_user_counts": sql(EVENT_TAGS, USER_CELLS, select="SELECT * FROM cells"),
    "window_token_stats": sql(DOC_TAGS, TOKENS, select=f"""
      SELECT {window_s(10)} AS window_s, tag, CAST(sum(tokens) AS BIGINT) AS tokens, max(longest) AS longest
      FROM dt JOIN tok_stats USING (tweet_id) GROUP BY 1, 2"""),
    "online_regression_users": sql(EVENT_TAGS, USER_CELLS, USER_POINTS.format(where=""), online("points"), select="""
      SELECT window_s, tag, uses, users, round(prediction, 6) AS prediction FROM preds"""),
    "online_regression_words": sql(DOC_TAGS, WORD_CELLS.format(where=""), online("points"), select="""
      SELECT window_s, tag, round(y, 6) AS avg_words, round(prediction, 6) AS prediction FROM preds"""),
    "compare_tag_count": COMPARE_COUNT,
    "compare_users": COMPARE_USERS,
    "compare_country_tags": COMPARE_TAGS,
    "compare_tag_count_updates": sql(*COUNTS, select=f"""
      SELECT tag, us AS ts_us, tweet_id, tag_pos,
             {label("coalesce(CAST(rec.uses AS VARCHAR), 'NONE')", "live.uses")} AS result
      FROM (SELECT *, count(*) OVER (PARTITION BY tag ORDER BY {ARRIVAL} ROWS UNBOUNDED PRECEDING) AS uses
            FROM et WHERE lang = 'en') live LEFT JOIN rec USING (tag)"""),
    "compare_users_updates": sql(
        DOC_TAGS, EVENT_TAGS, RUNNING_USERS, USER_STATES, USER_PARTS.format(name="rec", rows="dt"), select=f"""
      SELECT tag, ts_us, tweet_id, tag_pos, part, {label(or_none("rec.users"), "text")} AS result
      FROM ru JOIN states USING (tag, users) LEFT JOIN rec USING (tag, part)
      UNION ALL SELECT tag, us, tweet_id, tag_pos, part, {label("rec.users", "''")}
      FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY {ARRIVAL}) AS nth FROM et) JOIN rec USING (tag)
      WHERE nth = 1 AND part > 0"""),
    "compare_country_tags_updates": sql(
        DOC_TAGS, EVENT_TAGS, running_country("et"), COUNTRY_PARTS.format(name="rec", rows="dt"), select=f"""
      SELECT country, ts_us, tweet_id, tag_pos, part, {label(or_none("rec.tags || ';'"), "text")} AS result
      FROM rc LEFT JOIN rec USING (country, part)
      UNION ALL SELECT country, us, tweet_id, tag_pos, part, {label("rec.tags || ';'", "''")}
      FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY {ARRIVAL}) AS nth FROM et WHERE country IS NOT NULL)
        JOIN rec USING (country) WHERE nth = 1 AND part > 0"""),
    "recorded_result_sizes": sql(DOC_TAGS, select="""
      SELECT 'counts' AS result, count(DISTINCT tag) AS groups FROM dt WHERE lang = 'en' AND length(text) > 0
      UNION ALL SELECT 'users', count(DISTINCT tag) FROM dt
      UNION ALL SELECT 'countries', count(DISTINCT country) FROM dt"""),
    "recorded_series": sql(DOC_TAGS, select=f"""
      SELECT tag, (point - 1) // {COUNTRY_PART} AS part, (point - 1) % {COUNTRY_PART} AS place, avg_words,
             us // 1000 - (SELECT min(us) // 1000 FROM dt) AS elapsed_ms
      FROM (SELECT tag, us, count(*) OVER w AS point, CAST(sum(words) OVER w AS DOUBLE) / count(*) OVER w AS avg_words
            FROM dt WINDOW w AS (PARTITION BY tag ORDER BY {ARRIVAL} ROWS UNBOUNDED PRECEDING))"""),
    "start_end_events": sql(RIDES.format(join="JOIN orders ON l_orderkey = o_orderkey"), f"""
      ev AS (
        SELECT row_no, 'START' AS kind, epoch_us(o_orderdate) // 1000000 AS at_s, 0 AS other_s, o_orderdate AS "at",
               TIMESTAMP '1970-01-01 00:00:00' AS other, {RIDE_REST} FROM rides
        UNION ALL
        SELECT row_no, 'END', epoch_us(l_shipdate) // 1000000, epoch_us(o_orderdate) // 1000000, l_shipdate, o_orderdate,
               {RIDE_REST} FROM rides)""", select="""
      SELECT row_no, kind, at_s, other_s, c11, c12, c13, c14, c8, c1, c2,
             row_number() OVER (ORDER BY "at", other, c11, c12, c13, c14, c8, c1, c2, row_no, kind) AS position FROM ev"""),
    "row_numbered_projection": sql(RIDES.format(join=""), select="""
      SELECT row_no, CAST(l_orderkey AS VARCHAR) AS c1, CAST(l_partkey AS VARCHAR) AS c2,
             CAST(l_linenumber AS VARCHAR) AS c4, CAST(l_quantity AS VARCHAR) AS c5,
             CAST(l_returnflag AS VARCHAR) AS c9, CAST(l_linestatus AS VARCHAR) AS c10,
             CAST(l_shipdate AS VARCHAR) AS c11 FROM rides"""),
    "tag_keyword_filter": sql(DOCS, select="""
      SELECT tweet_id, lang FROM docs
      WHERE contains(lower(h0), 'rc1') OR contains(lower(h1), 'rc1') OR contains(lower(h0), 'fr') OR contains(lower(h1), 'fr')"""),
    "english_word_counts": sql(DOCS, select="""
      SELECT word, count(*) AS uses
      FROM (SELECT lower(replace(unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')), chr(11), '')) AS word
            FROM docs WHERE lang = 'en') WHERE word <> '' GROUP BY 1"""),
    "unit_projections": sql(EVENT_TAGS, select="""
      SELECT tag, count(*) AS uses, count(DISTINCT user_name) AS users FROM et GROUP BY 1"""),
    "raw_units": sql(DOC_TAGS, select="SELECT user_name, length(text) AS chars, CAST(1 AS BIGINT) AS unit FROM dt"),
    "stream_tag_count": TAG_COUNT_EN,
    "stream_users_per_tag": USERS_PER_TAG,
    "stream_tags_per_country": TAGS_PER_COUNTRY,
    "stream_avg_words": sql(DOC_TAGS, select=f"""
      SELECT tag, {AVG_COLUMNS}, CAST(sum(words) AS BIGINT) AS words, max(us) AS last_us FROM dt GROUP BY 1"""),
    "stream_longest_word": sql(
        DOC_TAGS, TOKENS, LONGEST.format(key=f"{window_s(20)},", where=f"tag IN ({TAG_LIST})").replace(
            f"SELECT {window_s(20)},", f"SELECT {window_s(20)} AS window_s,"),
        select=f"SELECT window_s, tag, word, length FROM ranked WHERE nth = 1 AND {closed(20).format(posts=f'dt WHERE tag IN ({TAG_LIST})')}"),
    "stream_window_avg_words": sql(DOC_TAGS, select=f"""
      SELECT * FROM (SELECT {window_s(600)} AS window_s, tag, {AVG_COLUMNS}, CAST(sum(words) AS BIGINT) AS words, max(us) AS last_us
                     FROM dt GROUP BY 1, 2) WHERE {closed(600).format(posts='docs')}"""),
    "stream_window_user_counts": sql(EVENT_TAGS, USER_CELLS, select=f"""
      SELECT * FROM cells WHERE {closed(3600).format(posts='evs')}"""),
    "stream_regression_scored": sql(DOC_TAGS, TOKENS, FIT, select=f"""
      SELECT window_s, tag, tokens, longest, round(intercept + slope * tokens, 6) AS prediction
      FROM (SELECT {window_s(10)} AS window_s, tag, CAST(sum(tokens) AS BIGINT) AS tokens, max(longest) AS longest
            FROM dt JOIN tok_stats USING (tweet_id) GROUP BY 1, 2), model
      WHERE {closed(10).format(posts='docs')}"""),
    "stream_online_regression": sql(
        EVENT_TAGS, USER_CELLS, USER_POINTS.format(where="WHERE " + closed(3600).format(posts="evs")), online("points"),
        select="SELECT window_s, tag, uses, users, round(prediction, 6) AS prediction FROM preds"),
    "stream_online_regression_words": sql(
        DOC_TAGS, WORD_CELLS.format(where="WHERE " + closed(60).format(posts="docs")), online("points"),
        select="SELECT window_s, tag, round(y, 6) AS avg_words, round(prediction, 6) AS prediction FROM preds"),
    "stream_compare_tag_count": COMPARE_COUNT,
    "stream_compare_users": COMPARE_USERS,
    "stream_compare_country_tags": COMPARE_TAGS,
    "compare_users_longer_record": COMPARE_USERS_TURNED,
    "stream_compare_users_longer_record": COMPARE_USERS_TURNED,
    "compare_users_updates_longer_record": sql(
        DOC_TAGS, EVENT_TAGS, RUNNING_USERS.replace("FROM et", "FROM dt"), USER_STATES, USER_PARTS.format(name="rec", rows="et"), select=f"""
      SELECT tag, ts_us, tweet_id, tag_pos, part, {label(or_none("rec.users"), "text")} AS result
      FROM ru JOIN states USING (tag, users) LEFT JOIN rec USING (tag, part)
      UNION ALL SELECT tag, us, tweet_id, tag_pos, part, {label("rec.users", "''")}
      FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY {ARRIVAL}) AS nth FROM dt) JOIN rec USING (tag)
      WHERE nth = 1 AND part > 0"""),
    "raw_log_copy": sql(DOCS, select=RAW),
    "stream_finished_longest_word": sql(
        DOC_TAGS, TOKENS, LONGEST.format(key=f"{window_s(20)},", where=f"tag IN ({TAG_LIST})").replace(
            f"SELECT {window_s(20)},", f"SELECT {window_s(20)} AS window_s,"),
        select="SELECT window_s, tag, word, length FROM ranked WHERE nth = 1"),
    "stream_finished_avg_words": sql(DOC_TAGS, select=f"""
      SELECT {window_s(600)} AS window_s, tag, {AVG_COLUMNS}, CAST(sum(words) AS BIGINT) AS words, max(us) AS last_us
      FROM dt GROUP BY 1, 2"""),
    "stream_finished_user_counts": sql(EVENT_TAGS, USER_CELLS, select="SELECT * FROM cells"),
    "stream_finished_regression_scored": sql(DOC_TAGS, TOKENS, FIT, select=f"""
      SELECT window_s, tag, tokens, longest, round(intercept + slope * tokens, 6) AS prediction
      FROM (SELECT {window_s(10)} AS window_s, tag, CAST(sum(tokens) AS BIGINT) AS tokens, max(longest) AS longest
            FROM dt JOIN tok_stats USING (tweet_id) GROUP BY 1, 2), model"""),
    "stream_finished_online_regression": sql(EVENT_TAGS, USER_CELLS, USER_POINTS.format(where=""), online("points"), select="""
      SELECT window_s, tag, uses, users, round(prediction, 6) AS prediction FROM preds"""),
    "stream_finished_online_regression_words": sql(DOC_TAGS, WORD_CELLS.format(where=""), online("points"), select="""
      SELECT window_s, tag, round(y, 6) AS avg_words, round(prediction, 6) AS prediction FROM preds"""),
}
ORACLES |= {
    f"stream_{name}": ORACLES[name] for name in ("running_tag_count", "running_avg_words", "compare_tag_count_updates")}
ORACLES |= {
    "layer_tag_count": TAG_COUNT_EN,
    "layer_users_per_tag": USERS_PER_TAG,
    "increments_tag_count": TAG_COUNT_EN,
    "increments_avg_words": ORACLES["stream_avg_words"],
    "increments_longest_word": sql(DOC_TAGS, TOKENS, LONGEST.format(key="", where="true"), select="""
      SELECT tag, word, length FROM ranked WHERE nth = 1"""),
    "increments_token_stats": ORACLES["token_stats_per_tag"],
}

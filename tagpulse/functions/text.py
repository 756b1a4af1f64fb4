"""Column expressions over post text. All stay in the JVM."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words (letters, digits, combining marks, underscore) and runs of other non-blank characters.
# The same on every JVM version and in RE2.
TOKEN = r"[\p{L}\p{Nd}\p{Mn}_]+|[^\p{L}\p{Nd}\p{Mn}_ \t\n\x0B\f\r]+"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def word_count(text: Column) -> Column:
    """Words between single spaces: one more than the number of spaces, whatever surrounds them."""
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).cast("long")


def text_length(text: Column, utf16=False) -> Column:
    """Length in code points, or in UTF-16 units (an emoji counts 2)."""
    if utf16:
        return (F.length(F.encode(text, "UTF-16BE")) / 2).cast("int")
    return F.length(text)


def json_quoted(value: Column) -> Column:
    """The value as a JSON string literal, with its quotes and escapes."""
    doc = F.to_json(F.struct(value.alias("v")))
    return F.substr(doc, F.lit(6), F.length(doc) - 6)


def with_token_stats(tweets: DataFrame, utf16=False) -> DataFrame:
    """Adds `tokens` (how many) and `longest` (length of the longest) per post.

    Reduced per post, before any explode of hashtags, so no word ever becomes a row.
    """
    return (
        tweets.where(F.col("text").rlike(r"[^ \t\n\x0B\f\r]"))
        .withColumn("_lengths", F.transform(tokens(F.col("text")), lambda w: text_length(w, utf16)))
        .withColumn("tokens", F.size("_lengths").cast("long"))
        .withColumn("longest", F.array_max("_lengths").cast("long"))
        .drop("_lengths")
    )


def with_longest_word(tweets: DataFrame, utf16=False) -> DataFrame:
    """Adds `word`, the first of the longest tokens of the post, and its `length`.

    Empty text is one empty token; text of blanks only has none and is dropped. The test is on
    the text rather than on the result, so that it is pushed down without splitting twice.
    """
    text = F.col("text")
    return (
        tweets.where((text == "") | text.rlike(r"[^ \t\n\x0B\f\r]"))
        .withColumn("_tokens", F.when(text == "", F.array(F.lit(""))).otherwise(tokens(text)))
        .withColumn("_lengths", F.transform("_tokens", lambda w: text_length(w, utf16)))
        .withColumn("_longest", F.array_max("_lengths"))
        .withColumn("word", F.element_at("_tokens", F.array_position("_lengths", F.col("_longest")).cast("int")))
        .withColumn("length", F.col("_longest").cast("long"))
        .drop("_tokens", "_lengths", "_longest")
    )

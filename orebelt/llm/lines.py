"""Line dedup by a log-template tree.

As in the Drain parser (He et al., 2017), a line descends a tree of fixed depth: by its number
of tokens, then by its leading tokens with those that hold digits masked. Within the leaf it
reaches, a position whose token recurs in enough texts is constant, any other is a variable
field; constants and wildcards are the line's template. Lines of templates that recur across
documents are dropped.

Copies of a document repeat all their lines too, and are no reason to drop one. So a template
counts the kinds of texts it stands in, not the texts: each text keeps a sketch, the least
hashes of its pieces of five words, and of the texts that share a template only those count that
are the first to bring most of their sketch. A copy shares most of its sketch with an earlier
text; a page that shares no more than a header, a footer or a passage does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebelt.llm.common import BLANK_WORD, words
from orebelt.session import materialize

WILDCARD = "<*>"
#: Words of a piece, which never crosses a line, and hashes of a sketch.
PIECE, SKETCH = 5, 12


def _masked(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), F.lit(WILDCARD)).otherwise(t))


def _text_key(text: Column) -> Column:
    """60 bits of a text's MD5, a number that SQL can form as well."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _sketch(tokens: Column) -> Column:
    """The least hashes of the pieces of all lines; an edit changes the pieces of its line only."""
    piece = lambda t, i: F.md5(F.concat_ws(" ", *[F.get(t, i + j) for j in range(PIECE)]).cast("binary"))
    starts = lambda t: F.sequence(F.lit(0), F.array_size(t) - 1, F.lit(PIECE))
    pieces = F.transform(F.filter(tokens, lambda t: F.array_size(t) > 0), lambda t: F.transform(starts(t), lambda i: piece(t, i)))
    return F.slice(F.sort_array(F.array_distinct(F.flatten(pieces))), 1, SKETCH)


def _inventory(docs: DataFrame, min_tokens: int, depth: int, text: str) -> DataFrame:
    """``text_key, pos, line_key, leaf`` of every line of at least ``min_tokens`` tokens."""
    rows = docs.where(F.col(text).isNotNull()).select(_text_key(F.col(text)).alias("text_key"), F.split(text, "\n").alias("lines"))
    rows = rows.select("text_key", "lines", F.transform("lines", lambda x: words(x, BLANK_WORD)).alias("tokens"))
    each = F.transform(
        "tokens",
        lambda t, i: F.when(
            F.array_size(t) >= min_tokens,
            F.struct(
                i.alias("pos"),
                F.xxhash64(F.get("lines", i)).alias("line_key"),
                F.xxhash64(F.array_size(t), _masked(F.slice(t, 1, depth))).alias("leaf"),
            ),
        ),
    )
    return rows.select("text_key", F.inline(F.filter(each, lambda x: x.isNotNull())))


def _in_texts(seen: DataFrame, key: str, min_docs: int) -> DataFrame:
    """Keys that stand in ``min_docs`` different texts."""
    return seen.select(key, "text_key").distinct().groupBy(key).agg(F.count("*").alias("n_texts")).where(F.col("n_texts") >= min_docs)


def _recurring(places: DataFrame, docs: DataFrame, min_docs: int, text: str) -> DataFrame:
    """``t, n_docs`` of the templates that ``min_docs`` texts of different content share.

    ``places`` holds ``t, text_key``. Every step adds up before it shuffles, so neither a
    template of most texts nor a large group of copies meets in one task.
    """
    places = places.select("t", "text_key").distinct()
    places = materialize(places.join(_in_texts(places, "t", min_docs).select("t"), "t", "left_semi"), "shared_templates")
    texts = docs.where(F.col(text).isNotNull()).select(_text_key(F.col(text)).alias("text_key"), F.col(text).alias("body"))
    texts = texts.join(places.select("text_key").distinct(), "text_key", "left_semi")
    tokens = F.transform(F.split("body", "\n"), lambda x: words(x, BLANK_WORD))
    sketches = texts.select("text_key", _sketch(tokens).alias("sketch")).dropDuplicates(["text_key"])
    pieces = places.join(sketches, "text_key").select("t", "text_key", F.size("sketch").alias("size"), F.explode("sketch").alias("piece"))
    brought = pieces.groupBy("t", "piece").agg(F.min(F.struct("text_key", "size")).alias("first"))
    firsts = brought.groupBy("t", "first").agg(F.count("*").alias("n")).where(2 * F.col("n") > F.col("first.size"))
    return firsts.groupBy("t").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= min_docs)


def line_templates(docs: DataFrame, min_docs: int = 3, min_tokens: int = 3, depth: int = 3, constant: float = 0.6, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The inventory of lines, and ``line_key, template, n_docs`` of each line whose template recurs.

    ``min_docs``: different texts in which a token must recur at its position of a leaf to be
    constant, and texts of different content (see :func:`_recurring`) in which a template must
    recur, at any number of texts. A text counts if it is the first, by its key, to bring more
    than half of its sketch to the template. Lines of fewer than ``min_tokens`` tokens, which
    recur by chance, or with a smaller share of constants than ``constant``, have no template.
    """
    seen = materialize(_inventory(docs, min_tokens, depth, text), "lines")
    crowded = _in_texts(seen, "leaf", min_docs)
    mine = materialize(seen.join(crowded.select("leaf"), "leaf", "left_semi"), "crowded_lines")
    weights = mine.groupBy("leaf", "line_key", "text_key").agg(F.lit(1).alias("one")).groupBy("leaf", "line_key").agg(F.count("*").alias("n"))
    holders = mine.groupBy("line_key").agg(F.min("text_key").alias("text_key"))  # one text is read for each line
    wanted = holders.groupBy("text_key").agg(F.collect_set("line_key").alias("keys"))
    bodies = docs.where(F.col(text).isNotNull()).select(_text_key(F.col(text)).alias("text_key"), F.col(text).alias("body"))
    bodies = bodies.join(wanted.select("text_key"), "text_key", "left_semi").select("text_key", F.explode(F.array_distinct(F.split("body", "\n"))).alias("line"))
    bodies = bodies.select("text_key", F.xxhash64("line").alias("line_key"), "line").join(holders, ["text_key", "line_key"], "left_semi")
    bodies = bodies.groupBy("line_key").agg(F.min("line").alias("line")).join(weights, "line_key")
    bodies = materialize(bodies.select("leaf", "line_key", "n", _masked(words(F.col("line"), BLANK_WORD)).alias("tokens")), "line_tokens")
    tokens = bodies.select("leaf", "line_key", "n", F.posexplode("tokens").alias("at", "token")).where(F.col("token") != WILDCARD)
    support = tokens.groupBy("leaf", "at", "token").agg(F.sum("n").alias("support")).where(F.col("support") >= min_docs)
    constants = tokens.join(support, ["leaf", "at", "token"]).groupBy("leaf", "line_key").agg(F.sort_array(F.collect_list("at")).alias("at"))
    full = bodies.join(constants, ["leaf", "line_key"]).where(F.size("at") >= F.lit(constant) * F.size("tokens"))
    parts = F.transform("tokens", lambda t, i: F.when(F.array_contains("at", i), t).otherwise(F.lit(WILDCARD)))
    full = materialize(full.select("line_key", F.array_join(parts, " ").alias("template")).withColumn("t", F.xxhash64("template")), "templates")
    spread = _recurring(mine.join(full.select("line_key", "t"), "line_key"), docs, min_docs, text)
    return seen, full.join(spread, "t").select("line_key", "template", "n_docs")


def drop_recurring_lines(
    docs: DataFrame, min_docs: int = 3, min_tokens: int = 3, depth: int = 3, constant: float = 0.6, text: str = "text", counts: bool = False
) -> DataFrame:
    """``docs`` with the lines of recurring templates cut from ``text``.

    All rows and columns stay; a text loses whole lines only, and one that consists of
    boilerplate becomes empty. Null and empty texts stay as they are; repeated rows are treated
    alike; an empty table gives an empty table. A very long text is one value, as it is in the
    table, and its lines are rows from there on. Which of several alike texts counts does not
    change what is dropped from them. ``counts=True`` appends ``_n_lines`` and ``_n_dropped``,
    so columns of these names must not be among ``docs``.
    """
    seen, found = line_templates(docs, min_docs, min_tokens, depth, constant, text)
    gone = seen.join(found.select("line_key"), "line_key", "left_semi")
    gone = gone.groupBy("text_key").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _text_key(F.col(text)).alias("k"))
    both = whole.join(gone, whole["k"] == gone["text_key"], "left")
    lines = F.split(F.col("row").getField(text), "\n")
    both = both.select("row", "gone", lines.alias("lines"))
    first, last = F.concat(F.array(F.lit(-1)), "gone"), F.concat("gone", F.array(F.size("lines")))
    kept = F.flatten(F.zip_with(first, last, lambda a, b: F.slice("lines", a + 2, b - a - 1)))
    body = F.when(F.col("gone").isNull(), F.col("row").getField(text)).otherwise(F.array_join(kept, "\n"))
    extra = [F.coalesce(F.array_size("lines"), F.lit(0)).cast("long").alias("_n_lines"), F.coalesce(F.array_size("gone"), F.lit(0)).cast("long").alias("_n_dropped")]
    return both.select(F.col("row").withField(f"`{text}`", body).alias("row"), *extra).select("row.*", *(["_n_lines", "_n_dropped"] if counts else []))

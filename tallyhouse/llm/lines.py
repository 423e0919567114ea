"""Line de-duplication by a log-template tree, in DataFrame functions only.

A line's place in the tree is its number of tokens and its first `DEPTH` tokens, tokens with a digit generalised to <*>: a
leaf. Within a leaf, a position whose tokens agree in more than half of the texts keeps that token, any other position
becomes <*>; lines that fit this pattern share it as their template if at least `CONSTANT` percent of its positions are
constant, all other lines are their own template. A template that occurs in at least `min_texts` different texts recurs,
and its lines are dropped from every text but the first (the one with the smallest doc_id), so nothing is lost for good.

Different texts are counted, not documents: a thousand copies of one page say nothing about its lines and stay equal to
each other. The decision about a line depends on its text alone, so everything is keyed by the text's hash.

Plan: one pass over the lines moves a leaf hash and a text hash a line to find the leaves in enough texts; only lines of those
leaves are looked at again. Those leaves, and the recurring templates, are broadcast up to `BROADCAST_LEAVES` of them, beyond
that they are joined.

Defined results: null texts have no lines and stay null; lines of fewer than `MIN_TOKENS` tokens and blank lines stay; a text all
of whose lines go becomes empty; rows without doc_id come last in the order of texts, ties go to the smaller hash;
equal rows give equal rows; empty tables work; other columns are kept, whatever their names. Leaves and templates are
told apart by 64-bit hashes, texts by 128 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import stored
from tallyhouse.llm.words import let, single_spaced, words

DEPTH, MIN_TOKENS, MIN_TEXTS, CONSTANT = 4, 3, 10, 60
BROADCAST_LEAVES = 1_000_000
ANY = "<*>"


def _masked(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), ANY).otherwise(t))


def _leaf(line: Column) -> Column:
    """Hash of token count and leading tokens; null for lines too short to be judged.

    Where single spaces part the tokens, they are counted by their spaces and only the leading ones are split off.
    """

    def head(x: Column) -> Column:
        spaces = F.octet_length(x) - F.octet_length(F.replace(x, F.lit(" "), F.lit("")))
        plain = F.struct((spaces + 1).alias("n"), F.slice(F.split(x, " ", DEPTH + 1), 1, DEPTH).alias("lead"))
        other = let(words(x), lambda w: F.struct(F.size(w).alias("n"), F.slice(w, 1, DEPTH).alias("lead")))
        return F.when(single_spaced(x), plain).otherwise(other)

    return let(line, lambda x: let(head(x), lambda h: F.when(h["n"] >= MIN_TOKENS, F.xxhash64(h["n"], _masked(h["lead"])))))


def _text_key() -> Column:
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def _lines(docs: DataFrame) -> DataFrame:
    """key, doc_id, pos, line, leaf of the lines that can be judged."""
    rows = docs.select(_text_key().alias("key"), "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return rows.withColumn("leaf", _leaf(F.col("line"))).filter("leaf IS NOT NULL")


def _hot_lines(docs: DataFrame, min_texts: int) -> DataFrame:
    """Lines of leaves that occur in enough texts, with masked tokens and their hash."""
    texts = _lines(docs).select("leaf", "key.*").groupBy("leaf", "a", "b").agg(F.lit(1).alias("one"))
    leaves = stored(texts.groupBy("leaf").agg(F.count("*").alias("n")).filter(F.col("n") >= min_texts).select("leaf"), "leaves")
    if leaves.count() <= BROADCAST_LEAVES:
        leaves = F.broadcast(leaves)
    hot = _lines(docs).join(leaves, "leaf").select("leaf", "key", "doc_id", "pos", _masked(words(F.col("line"))).alias("tokens"))
    return stored(hot.withColumn("own", F.xxhash64("leaf", "tokens")), "hot-lines")


def _templates(hot: DataFrame, constant: int) -> DataFrame:
    """(own, template) of every distinct masked line."""
    kinds = hot.groupBy("leaf", "own", "key").agg(F.lit(1).alias("one")).groupBy("leaf", "own").agg(F.count("*").alias("n"))
    tokens = hot.groupBy("own").agg(F.first("tokens").alias("tokens"))
    kinds = stored(kinds.join(tokens, "own"), "line-kinds")
    weight = kinds.groupBy("leaf").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).filter("kinds > 1")
    places = kinds.join(weight, "leaf").select("leaf", "own", "n", "total", F.posexplode("tokens").alias("p", "token"))
    fixed = places.groupBy("leaf", "p", "token").agg(F.sum("n").alias("w"), F.first("total").alias("total")).filter("2 * w > total")
    patterns = fixed.groupBy("leaf").agg(
        F.count("*").alias("n_fixed"), F.sum(F.when(F.col("token") != ANY, 1).otherwise(0)).alias("n_constant")
    )
    agrees = places.join(fixed.select("leaf", "p", "token"), ["leaf", "p", "token"]).groupBy("leaf", "own").agg(F.count("*").alias("n_agree"))
    fits = (
        agrees.join(patterns, "leaf")
        .join(kinds.select("own", F.size("tokens").alias("n_tokens")), "own")
        .filter((F.col("n_agree") == F.col("n_fixed")) & (100 * F.col("n_constant") >= constant * F.col("n_tokens")))
        .select("own", F.xxhash64(F.lit("pattern"), F.col("leaf")).alias("pattern"))
    )
    return kinds.select("own").join(fits, "own", "left").select("own", F.coalesce("pattern", "own").alias("template"))


def dropped_lines(docs: DataFrame, min_texts: int = MIN_TEXTS, constant: int = CONSTANT) -> DataFrame:
    """(key, positions): the lines that go from each text that loses any."""
    hot = _hot_lines(docs, min_texts)
    templates = stored(_templates(hot, constant), "templates")
    if templates.count() <= BROADCAST_LEAVES:
        templates = F.broadcast(templates)
    lines = hot.join(templates, "own").select("template", "key", "doc_id", "pos")
    lines = stored(lines, "template-lines")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    texts = lines.groupBy("template", "key").agg(F.min(order).alias("o"))
    recurring = texts.groupBy("template").agg(F.count("*").alias("n"), F.min("o").alias("first")).filter(F.col("n") >= min_texts)
    recurring = stored(recurring.select("template", F.col("first.key").alias("stays")), "recurring")
    if recurring.count() <= BROADCAST_LEAVES:
        recurring = F.broadcast(recurring)
    gone = lines.join(recurring, "template").filter("key != stays")
    return gone.select("key", "pos").distinct().groupBy("key").agg(F.collect_list("pos").alias("positions"))


def dedup(docs: DataFrame, min_texts: int = MIN_TEXTS, constant: int = CONSTANT, dropped: str | None = None) -> DataFrame:
    """The documents without their recurring lines; `dropped` names a column for the number of lines that went."""
    gone = dropped_lines(docs, min_texts, constant).select(F.col("key.a").alias("ka"), F.col("key.b").alias("kb"), "positions")
    rows = docs.select(F.struct("*").alias("d"), _text_key().alias("k"))
    rows = rows.join(gone, (rows["k.a"] == gone["ka"]) & (rows["k.b"] == gone["kb"]), "left")

    def rest(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("positions"))
        return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")

    text = F.when(F.col("positions").isNull(), F.col("d.text")).otherwise(let(F.split("d.text", "\n"), rest))
    n = F.coalesce(F.size("positions"), F.lit(0)).cast("long")
    columns = [text.alias("text") if c == "text" else F.col(f"d.`{c}`") for c in docs.columns]
    return rows.select(*columns, *([n.alias(dropped)] if dropped else []))

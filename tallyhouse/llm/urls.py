"""URL filter: host and path rules, and a character language-model ratio for the URLs that no rule judges.

Two smoothed variable-order Markov models are counted from all URLs that a rule accepts or rejects. A character is
predicted from its longest seen context of up to `ORDER` characters, interpolated with all shorter ones (Witten-Bell
weights: seen / (seen + kinds)). A URL's score is (log P(url | rejected) - log P(url | accepted)) per character, and it is
blocked above a threshold calibrated on accepted URLs that were kept out of the counts.

Size: characters are folded to 40 classes (letters, signs, all digits as one), so a model has at most 40**4 entries
however many URLs there are. Spark sums the counts over all URLs; only the model is broadcast.

Defined results: a null URL or one without "://" has empty host and path, no rule, and the model's verdict on the empty
string. Without accepted or without rejected URLs the model prefers neither, every score is 0 and nothing without a rule is
blocked. Equal rows give equal rows; empty tables work; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import stored
from tallyhouse.llm.words import let

ORDER = 3
SIGNS = "abcdefghijklmnopqrstuvwxyz./-_?=&%#:"
#: Classes: the start, the 36 signs from 1 on, a digit, anything else, the end.
START, DIGIT, OTHER, END, KINDS = 0, 37, 38, 39, 40
_CLASS = {c: i + 1 for i, c in enumerate(SIGNS)} | dict.fromkeys("0123456789", DIGIT)
#: One judged URL in HELD_OUT is kept out of the counts; the threshold blocks at most a share REFUSED of the accepted ones.
HELD_OUT, REFUSED = 5, 0.01


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def split_url(url: Column) -> Column:
    """Struct (host, path): host after the first "://" up to / ? # or the end, A-Z folded; path then up to ? or #."""
    given = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(given, "://") > 0, F.regexp_replace(given, r"(?s)^.*?://", "")).otherwise("")

    def parts(r: Column) -> Column:
        host = F.translate(F.regexp_extract(r, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        return F.struct(host.alias("host"), F.regexp_extract(r, r"^[^/?#]*([^?#]*)", 1).alias("path"))

    return let(rest, parts)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct (name, verdict) of the longest rule that fits, else null."""
    found = F.lit(None)
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _classes(text: str) -> list[int]:
    return [*([START] * ORDER), *(_CLASS.get(c, OTHER) for c in text.lower()), END]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (rejected, order, context and next character as one number) within a task."""
    seen: Counter = Counter()
    for batch in batches:
        for text, rejected in zip(batch["text"], batch["rejected"].to_pylist(), strict=True):
            c = _classes(text.as_py())
            for i in range(ORDER, len(c)):
                code, scale = c[i], KINDS
                seen[rejected, 0, code] += 1
                for order in range(1, ORDER + 1):
                    code, scale = code + c[i - order] * scale, scale * KINDS
                    seen[rejected, order, code] += 1
    keys = list(seen)
    columns = [pa.array([k[j] for k in keys], t) for j, t in enumerate((pa.bool_(), pa.int32(), pa.int32()))]
    yield pa.RecordBatch.from_arrays([*columns, pa.array(list(seen.values()), pa.int64())], names=["rejected", "order", "code", "n"])


class Model:
    """Log-probabilities of a character after a context, for the accepted and the rejected URLs.

    counts: for each of the two, for each order, {code: n}; a code is the next character plus KINDS times the context.
    """

    def __init__(self, counts: dict[bool, list[dict[int, int]]]):
        self.sides = []
        for side in (True, False):
            orders = counts[side]
            seen: list[Counter] = [Counter() for _ in orders]
            kinds: list[Counter] = [Counter() for _ in orders]
            for order, table in enumerate(orders):
                for code, n in table.items():
                    seen[order][code // KINDS] += n
                    kinds[order][code // KINDS] += 1
            self.sides.append((orders, seen, kinds))
        self.known = all(counts[side][0] for side in (True, False))
        self.memo: dict[tuple[int, ...], float] = {}

    def _chance(self, side: int, gram: tuple[int, ...]) -> float:
        """Probability of the last class of gram after the others, nearest last."""
        orders, seen, kinds = self.sides[side]
        p, code, scale = 1.0 / KINDS, gram[-1], KINDS
        for order in range(ORDER + 1):
            if order:
                code, scale = code + gram[-1 - order] * scale, scale * KINDS
            context = code // KINDS
            n = seen[order][context]
            if not n:
                break
            k = kinds[order][context]
            p = (orders[order].get(code, 0) + k * p) / (n + k)
        return p

    def score(self, text: str) -> float:
        """Log-likelihood difference per character, rejected minus accepted."""
        if not self.known:
            return 0.0
        c, total = _classes(text), 0.0
        for i in range(ORDER, len(c)):
            gram = tuple(c[i - ORDER : i + 1])
            ratio = self.memo.get(gram)
            if ratio is None:
                ratio = self.memo[gram] = log(self._chance(0, gram)) - log(self._chance(1, gram))
            total += ratio
        return total / (len(c) - ORDER)


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Model(model.value)
        for batch in batches:
            scores = pa.array([scorer.score(t.as_py()) for t in batch["text"]], pa.float64())
            yield batch.set_column(batch.schema.get_field_index("score"), "score", scores)

    return run


def count_model(urls: DataFrame) -> dict[bool, list[dict[int, int]]]:
    """The counts of all rows (text, rejected); at most 2 * (40 + ... + 40**4) of them, however many rows there are."""
    rows = urls.select("text", "rejected").mapInArrow(_count, "rejected boolean, order int, code int, n long")
    counts: dict[bool, list[dict[int, int]]] = {side: [{} for _ in range(ORDER + 1)] for side in (False, True)}
    for rejected, order, code, n in rows.groupBy("rejected", "order", "code").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[rejected][order][code] = n
    return counts


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score (null where a rule judges), threshold; one row per page."""
    parts = pages.select("page_id", F.col("url"), split_url(F.col("url")).alias("p"))
    ruled = parts.select("page_id", "url", "p.*", rule_of(F.col("p.host"), F.col("p.path"), rules).alias("r"))
    # What the models read: host and path with query, without the scheme, which says nothing about the page.
    text = F.regexp_replace(F.coalesce("url", F.lit("")), r"(?s)^.*?://", "")
    rows = ruled.select(
        "page_id", "host", "path", F.col("r.name").alias("rule"), F.col("r.verdict").alias("by_rule"), text.alias("text"),
        (F.pmod(F.xxhash64(F.col("url")), F.lit(HELD_OUT)) == 0).alias("held"),
    )
    judged = rows.filter(F.col("rule").isNotNull()).withColumn("rejected", F.col("by_rule") == "block")
    model = pages.sparkSession.sparkContext.broadcast(count_model(judged.filter(~F.col("held"))))
    schema = rows.withColumn("score", F.lit(0.0)).schema
    scored = rows.withColumn("score", F.lit(0.0)).mapInArrow(_scorer(model), schema)
    scored = stored(scored.drop("text"), "url-scores")
    calibration = scored.filter(F.col("held") & (F.col("by_rule") == "allow"))
    threshold = calibration.agg(F.percentile_approx("score", 1 - REFUSED, 100_000)).first()[0]
    limit = F.lit(max(threshold, 0.0) if threshold is not None else 0.0)
    by_model = F.when(F.col("score") > limit, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", by_model).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("score")).alias("score"), limit.alias("threshold"),
    )


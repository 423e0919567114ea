"""Personal data and secrets replaced by keyed surrogates.

Detected: e-mail addresses, phone numbers, IPv4 and IPv6 addresses, payment card numbers, IBANs, social security numbers, cloud
access keys, values of password or token assignments, and names after a title. A value is first brought to a canonical
form (letters folded, separators dropped); its surrogate comes from HMAC-SHA256 of a secret key, the type and that
form, so a value has the same surrogate wherever and however it is written. Surrogates keep type and format: letters
stay letters, digits digits, separators stay; a phone keeps its country code, a card its network digit and its Luhn
sum, an IBAN its country and check sum, a name its script, gender (told by the title) and case; addresses come
from ranges nobody uses. The parts of an e-mail address and the words of a name are replaced one by one, so that people of one
domain or family stay together and "Mr. Smith" stays the "Mr. John Smith" of another page.

Collision check: the distinct values of the whole corpus are a table. Where two values of a type get one surrogate, or a
surrogate is itself a value that occurs, all but the first value (or that value) try again with the next attempt
number, until no collision is left. The parts before the @ are told apart within their domain, so whole addresses differ.
Surrogates get longer with the attempts: values of a format with few forms (one letter before the @, a short phone
number) find one after all, if a longer one. Values of signs only, such as masked passwords, become letters. Tasks compute surrogates themselves; only values with an attempt above 0 have to be looked
up. They are broadcast up to `BROADCAST_RETRIES` of them, beyond that they are joined to the texts that have them.

Defined results: null texts stay null, empty texts empty; equal rows give equal rows; empty tables work; other columns are
kept, whatever their names. Overlapping finds: the earlier, then the longer wins.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import stored

BROADCAST_RETRIES = 200_000
#: Values remembered in a task.
HELD = 100_000

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_CAPITAL = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][\w'’-]+"
#: Titles and the gender they tell.
TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Herrn": "m", "Señor": "m", "Sr": "m", "Don": "m", "Monsieur": "m", "господин": "m", "г-н": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Señora": "f", "Señorita": "f", "Sra": "f", "Doña": "f", "Madame": "f",
    "Mme": "f", "Mademoiselle": "f", "Mlle": "f", "госпожа": "f", "г-жа": "f", "Dr": "n", "Prof": "n",
}
_TITLE = "|".join(sorted(TITLES, key=len, reverse=True))

#: (type, needed character or None, pattern); the value is group 1.
PATTERNS: tuple[tuple[str, str | None, re.Pattern], ...] = (
    ("email", "@", re.compile(r"(?<!\w)(\w[\w.%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)")),
    ("ipv4", ".", re.compile(rf"(?<!\w)(?<!\d\.)((?:{_OCTET}\.){{3}}{_OCTET})(?!\w|\.\d)", re.ASCII)),
    ("ipv6", ":", re.compile(r"(?<![\w:])((?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4})(?![\w:])")),
    ("phone", "+", re.compile(r"(?<!\w)(\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,5}){1,4})(?!\w)", re.ASCII)),
    ("phone", "-", re.compile(r"(?<![\w+-])(\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})(?![\w-])", re.ASCII)),
    ("ssn", "-", re.compile(r"(?<![\w-])(\d{3}-\d{2}-\d{4})(?![\w-])", re.ASCII)),
    ("card", None, re.compile(r"(?<![\w+-])(?<!\d\.)([3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{3,4}|\d{13,19})(?![\w-])", re.ASCII)),
    ("iban", None, re.compile(r"(?<!\w)([A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?!\w)", re.ASCII)),
    ("key", None, re.compile(r"(?<!\w)((?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36})(?!\w)", re.ASCII)),
    ("secret", None, re.compile(r"(?i)(?:password|passwd|pwd|secret|token|api[_-]?key)[\"']?\s*[=:]\s*[\"']?([^\s\"',;&<>]{6,})")),
    ("name", None, re.compile(rf"(?<!\w)(?:{_TITLE})(?:\.|(?=\s))\s?((?:{_CAPITAL})(?:[ ]{_CAPITAL}){{0,2}})")),
)

#: Given names by script and gender, surname endings by script; surnames are made of syllables.
GIVEN = {
    ("latin", "m"): "Adam Bruno Carl Daniel Emil Felix Georg Hugo Ivan Jonas Karl Leo Martin Noel Oscar Paul Quentin Robert Simon Thomas".split(),
    ("latin", "f"): "Anna Berta Clara Diana Emma Frida Greta Helena Ida Julia Karin Laura Maria Nora Olga Paula Rosa Sofia Tara Vera".split(),
    ("latin", "n"): "Alex Andrea Charlie Dana Eli Jamie Jules Kim Lee Lou Mika Noa Pat Quinn Robin Sam Sascha Sky Toni Val".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Захар Иван Кирилл Лев Максим Никита Олег Павел Роман Степан".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лидия Мария Нина Ольга Полина Раиса София".split(),
    ("cyrillic", "n"): "Саша Женя Валя Слава Шура Тося Паша Миша".split(),
}
SYLLABLES = {
    "latin": [c + v for c in "b d f g h k l m n p r s t v w z".split() for v in "a e i o u".split()],
    "cyrillic": [c + v for c in "б в г д ж з к л м н п р с т".split() for v in "а е и о у".split()],
}


class Stream:
    """Keyed pseudo-random choices for one (type, value, attempt)."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.mac = hmac.new(key, f"{kind}\0{attempt}\0{value}".encode(), hashlib.sha256)
        self.n, self.state, self.left = 0, 0, 0

    def below(self, n: int) -> int:
        if self.left < 40:
            block = self.mac.copy()
            block.update(self.n.to_bytes(4, "big"))
            self.state, self.left, self.n = int.from_bytes(block.digest(), "big"), 256, self.n + 1
        value, self.state, self.left = self.state & 0xFFFFFFFF, self.state >> 32, self.left - 32
        return value * n >> 32

    def pick(self, items):
        return items[self.below(len(items))]

    def digits(self, n: int) -> str:
        return "".join(str(self.below(10)) for _ in range(n))

    def like(self, text: str) -> str:
        """Letters for letters of the same case (hex for hex values), digits for digits; letters for signs where nothing else is."""
        if not any(c.isalpha() or c.isdigit() for c in text):
            text = "x" * len(text)
        hexed = len(text) > 8 and re.fullmatch(r"(?=.*[a-f])[0-9a-f]+", text) is not None

        def one(c: str) -> str:
            if hexed:
                return self.pick("0123456789abcdef")
            if c.isdigit():
                return str(self.below(10))
            if c.isalpha():
                return self.pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ" if c.isupper() else "abcdefghijklmnopqrstuvwxyz")
            return c

        return "".join(map(one, text))


def luhn(digits: str) -> int:
    """Luhn sum modulo 10; 0 for a valid number."""
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10


def iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def script_of(word: str) -> str:
    return "cyrillic" if any("Ѐ" <= c <= "ӿ" for c in word) else "latin"


def parts_of(kind: str, value: str, gender: str = "n") -> list[tuple[str, str]]:
    """(type, canonical form) of what is replaced in a value, in order."""
    if kind == "email":
        local, _, domain = value.lower().partition("@")
        return [("local", f"{local}@{domain}"), ("domain", domain)]
    if kind == "name":
        found = value.split(" ")
        given = [(f"given/{script_of(w)}/{gender}", w.lower()) for w in found[:-1]]
        return [*given, (f"surname/{script_of(found[-1])}", found[-1].lower())]
    if kind in ("phone", "card", "ssn"):
        return [(kind, "".join(c for c in value if c.isdigit() or c == "+"))]
    if kind == "iban":
        return [(kind, value.replace(" ", ""))]
    return [(kind, value.lower() if kind == "ipv6" else value)]


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The surrogate of a canonical value, itself canonical."""
    s = Stream(key, kind, value, attempt)
    # Few forms may be left: further attempts add letters, digits or syllables.
    more = attempt // 4
    if kind == "local":
        return s.like(value.partition("@")[0]) + s.like("x" * more)
    if kind == "domain":
        return f"{s.like('x' * (8 + more))}.example.{s.pick(('com', 'net', 'org'))}"
    if kind == "ipv4":
        return f"{240 + s.below(15)}.{s.below(256)}.{s.below(256)}.{s.below(256)}" + "".join(f".{s.below(256)}" for _ in range(more))
    if kind == "ipv6":
        return "2001:db8:" + ":".join(f"{s.below(1 << 16):x}" for _ in range(6))
    if kind == "phone":
        head = re.match(r"\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})", value) if value[0] == "+" else None
        kept = head[0] if head else ""
        n = len(value) - len(kept)
        return kept + str(2 + s.below(8)) + s.digits(n - 1 + more)
    if kind == "card":
        body = value[0] + s.digits(len(value) - 2 + more)
        check = next(str(d) for d in range(10) if luhn(f"{body}{d}") == luhn(value))
        return body + check
    if kind == "ssn":
        return "9" + s.digits(len(value) - 1 + more)
    if kind == "iban":
        rest = s.like(value[4:]) + s.digits(more)
        return value[:2] + iban_check(value[:2], rest) + rest
    if kind == "key":
        return value[:4] + s.like(value[4:]) + s.like("x" * more)
    if kind.startswith("given/"):
        _, script, gender = kind.split("/")
        extra = "" if attempt < 4 else "".join(s.pick(SYLLABLES[script]) for _ in range(1 + more))
        return (s.pick(GIVEN[script, gender]) + extra).lower()
    if kind.startswith("surname/"):
        return "".join(s.pick(SYLLABLES[kind.split("/")[1]]) for _ in range(4 + more))
    return s.like(value) + s.like("x" * more)


def _cased(word: str, like: str) -> str:
    return word.upper() if len(like) > 1 and like.isupper() else word.capitalize() if like[:1].isupper() else word


def rendered(kind: str, value: str, found: list[str]) -> str:
    """The surrogates of a value's parts in the format in which the value was written."""
    if kind == "email":
        text = "@".join(found)
        return text.upper() if value.isupper() else text
    if kind == "name":
        return " ".join(_cased(w, like) for w, like in zip(found, value.split(" "), strict=True))
    if kind in ("phone", "card", "ssn", "iban"):
        rest = iter(c for c in found[0] if c != "+")
        return "".join([*(next(rest) if c.isalnum() else c for c in value), *rest])
    return found[0]


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, gender) of the values in a text, in order, without overlaps."""
    found = []
    for kind, needed, pattern in PATTERNS:
        if needed and needed not in text:
            continue
        for m in pattern.finditer(text):
            gender = "n"
            if kind == "name":
                gender = TITLES[re.match(rf"(?:{_TITLE})", m[0])[0]]
            elif kind == "iban" and iban_check(m[1][:2], m[1].replace(" ", "")[4:]) != m[1][2:4]:
                continue
            found.append((m.start(1), m.end(1), kind, gender))
    out: list[tuple[int, int, str, str]] = []
    for f in sorted(found, key=lambda f: (f[0], -f[1])):
        if not out or f[0] >= out[-1][1]:
            out.append(f)
    return out


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (kind, value) of a task, handed on whenever there are many."""
    seen: set[tuple[str, str]] = set()

    def emit() -> pa.RecordBatch:
        rows = list(seen)
        seen.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["kind", "value"])

    for batch in batches:
        for value in batch["text"]:
            text = value.as_py()
            for start, end, kind, gender in detect(text) if text else ():
                seen.update(parts_of(kind, text[start:end], gender))
            if len(seen) > HELD:
                yield emit()
    yield emit()


def _name_them(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = [surrogate(key, *row) for row in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
            yield batch.append_column("surrogate", pa.array(named, pa.string()))

    return run


def surrogates(docs: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, attempt, surrogate) of all distinct values; no two of a kind share a surrogate, none is a real value.

    Locals may share one in different domains. The rounds end because every kind has more surrogates the higher the attempt.
    """
    values = stored(docs.select("text").mapInArrow(_values, "kind string, value string").distinct(), "private-values")
    schema = "kind string, value string, attempt int, surrogate string"
    named = stored(values.withColumn("attempt", F.lit(0)).mapInArrow(_name_them(key), schema), "surrogates")
    real = values.select("kind", F.col("value").alias("whole"), F.lit(True).alias("real"))
    domain = F.substring_index("value", "@", -1)
    whole = F.when(F.col("kind") == "local", F.concat_ws("@", "surrogate", domain)).otherwise(F.col("surrogate")).alias("whole")
    while True:
        names = named.select("kind", "value", "attempt", whole)
        # The value with the fewest attempts keeps a surrogate that several have; a real value's name is nobody's.
        first = names.groupBy("kind", "whole").agg(F.min(F.struct("attempt", "value")).alias("f"), F.count("*").alias("n"))
        taken = first.join(real, ["kind", "whole"], "left").filter("n > 1 OR real")
        taken = taken.select("kind", "whole", F.when(F.col("real").isNull(), F.col("f.value")).alias("owner"))
        again = stored(names.join(taken, ["kind", "whole"]).filter("owner IS NULL OR value != owner").select("kind", "value", "attempt"), "again")
        if again.isEmpty():
            return named
        retried = again.withColumn("attempt", F.col("attempt") + 1).mapInArrow(_name_them(key), schema)
        named = stored(named.join(again.select("kind", "value"), ["kind", "value"], "left_anti").unionByName(retried), "surrogates")


def _replace(key: bytes, retries: Callable[[], dict], text_at: int, notes_at: int | None):
    """Replaces the values of each text; attempts above 0 come from `retries` or from the row's own notes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempts, met = retries(), {}

        def named(part: tuple[str, str], own: dict) -> str:
            attempt = own.get(part, attempts.get(part, 0))
            found = met.get((part, attempt))
            if found is None:
                if len(met) >= HELD:
                    met.clear()
                found = met[part, attempt] = surrogate(key, *part, attempt)
            return found

        for batch in batches:
            texts, spans = [], []
            notes = batch.column(notes_at).to_pylist() if notes_at is not None else [None] * len(batch)
            for value, noted in zip(batch.column(text_at), notes, strict=True):
                text, out, at, where = value.as_py(), [], 0, []
                own = {(x["kind"], x["value"]): x["attempt"] for x in noted or ()}
                for start, end, kind, gender in detect(text) if text else ():
                    written = text[start:end]
                    new = rendered(kind, written, [named(p, own) for p in parts_of(kind, written, gender)])
                    out += (text[at:start], new)
                    where.append({"start": start, "end": end, "kind": kind})
                    at = end
                texts.append(text if not out else "".join([*out, text[at:]]))
                spans.append(where)
            columns = list(batch.columns)
            columns[text_at] = pa.array(texts, pa.string())
            if notes_at is not None:
                columns.pop(notes_at)
            columns.append(pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))))
            names = [f"c{i}" for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _noted(docs: DataFrame, retried: DataFrame) -> DataFrame:
    """The documents with a column of the retried values of their texts, where there are too many to broadcast."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = [F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b")]
    found = docs.select(*keys, "text").distinct().mapInArrow(_values_by_text, "a long, b long, kind string, value string")
    notes = found.join(retried, ["kind", "value"]).groupBy("a", "b").agg(F.collect_list(F.struct("kind", "value", "attempt")).alias("notes"))
    rows = docs.select(F.struct("*").alias("d"), *keys)
    rows = rows.join(notes.withColumnsRenamed({"a": "na", "b": "nb"}), (F.col("a") == F.col("na")) & (F.col("b") == F.col("nb")), "left")
    return rows.select("d.*", "notes")


def _values_by_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for a, b, text in zip(*[batch[c].to_pylist() for c in ("a", "b", "text")], strict=True):
            parts = {p for start, end, kind, gender in detect(text or "") for p in parts_of(kind, text[start:end], gender)}
            rows += [(a, b, *p) for p in parts]
        types = (pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["a", "b", "kind", "value"])


def replace(docs: DataFrame, key: bytes, found: str = "found") -> DataFrame:
    """The documents with surrogates in their texts; `found` names the column of (start, end, kind) in the text as it was."""
    spark = docs.sparkSession
    retried = surrogates(docs, key).filter("attempt > 0").select("kind", "value", "attempt")
    text_at, rows, notes_at = docs.columns.index("text"), docs, None
    if retried.count() <= BROADCAST_RETRIES:
        shared = spark.sparkContext.broadcast({(r.kind, r.value): r.attempt for r in retried.toLocalIterator()})
        retries = lambda: shared.value
    else:
        rows, notes_at, retries = _noted(docs, retried), len(docs.columns), dict
    spans = "array<struct<start: int, end: int, kind: string>>"
    fields = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema)] + [f"c{len(docs.columns)} {spans}"]
    return rows.mapInArrow(_replace(key, retries, text_at, notes_at), ", ".join(fields)).toDF(*docs.columns, found)

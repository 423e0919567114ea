import random
import struct
import zlib
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.llm import queries, records
from tests.llm.conftest import ODD

FILE = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Path(FILE).read_text(encoding="utf-8")
TRICKY = [
    (-5, "It's the CAFÉ's 3rd, don't!? é <|endoftext|> Ünï.\r\n'tis x y ̸= a'll"), (8, "the\nthe, The. THE!! the's 12 a1b2"),
    (2**40, "İstanbul ΣΑΣ ß ﬁ 漢字 한국어 \U0001f600\U0001f600 ... ,,the"), (10, " lead  and trail \n\n"), (9, "x" * 70 + " " + "y" * 70 + ","),
]


def brute(rows):
    """(doc_id, start, n_tokens, ids_crc32) by whole-text encoding, in ascending doc_id order."""
    library, out, start = Tokenizer.from_file(FILE), [], 0
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def of(index):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in index.collect()), key=lambda r: r[1])


def test_index_is_that_of_whole_texts(docs, spark, tmp_path):
    rows = [*ODD, *TRICKY]
    for n, size in enumerate((1 << 25, 100_000)):  # one file, and several
        folder = str(tmp_path / str(n))
        records.write(docs(rows), folder, FILE, file_bytes=size)
        assert of(records.build_index(spark, folder)) == brute(rows)


class Counting(records.Encoder):
    calls = 0

    def ids(self, text):
        self.calls += 1
        return super().ids(text)


def encoded(texts, encoder=None):
    """Ids of every text from its frame, without the end id."""
    held = SimpleNamespace(value={"tokenizer": TOKENIZER} | ({} if encoder is None else {"encoder": encoder}))
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    frames = [f.as_py() + b"\n" for b in records._frames(held, None)(iter([batch])) for f in b["frame"]]
    return [records.ids_of(records.payload_at(f, 0, "f"))[1].tolist() for f in frames]


def whole(texts):
    return [e.ids for e in Tokenizer.from_file(FILE).encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]


def test_words_with_signs_are_encoded_together():
    """Different words with signs around them don't cost a call of the library each."""
    a = [chr(97 + i) + chr(97 + j) + chr(97 + k) for i in range(26) for j in range(13) for k in range(13)]
    texts = [f"{w}$$$ ({w}b)-c{w} \"{w}d\" é{w}&&& x{w}'s Ж{w}…" for w in a]
    encoder = Counting(TOKENIZER)
    assert encoded(texts, encoder) == whole(texts)
    assert encoder.calls < len(a) * 1.2  # only the words before a sign that is not ASCII


def test_odd_texts_in_any_order(monkeypatch):
    monkeypatch.setattr(records, "SLICE", 2000)
    monkeypatch.setattr(records, "MEMO", 300)
    odd = [
        "a", "B", "the", "S", "s", "t", "re", "LL", "É", "é", "e\u0301", "h\u0331", "H\u0331", "\u0338", "\u0327", "ſ", "K", "İ", "I\u0307", "ΣΑΣ", "ǅ", "½", "Ⅷ", "²",
        "Ж", "漢", "가", "\u1100\u1161", "नमस्ते", "\U0001f600", "'", "'", "’", "!", "-", "_", "|", "<", ">", "=", "@", "[", "\\", "]", "^", "`", "{", "}", "~", "1", "23",
        "<|endoftext|>", "<|STARTOFTEXT|>", "<|startoftext|>", " ", " ", "  ", "\n", "\r\n", "\t", "\u00a0", "\u2028", "\x00", "x" * 70,
    ]
    draw = random.Random(12)
    texts = ["".join(draw.choices(odd, k=draw.randrange(25))) for _ in range(6000)] + [None, "", "\n" * 5000]
    assert encoded(texts) == whole(texts)


def test_signs_beside_any_letter():
    letters = [c for c in map(chr, range(128, 0x110000)) if c.isalnum() or not 0xD800 <= ord(c) < 0xE000 and ord(c) < 0x32000 and c.isprintable()]
    texts = [" ".join(f"{c}! !{c} '{c} {c}' a{c}1 1{c}b" for c in letters[i : i + 100]) for i in range(0, len(letters), 100)]
    assert encoded(texts) == whole(texts)


def test_shuffled_and_single_reads(docs, spark, tmp_path):
    rows, folder = [(i, f"word number {i}\n" * (i % 7)) for i in range(300)], str(tmp_path / "r")
    records.write(docs(rows), folder, FILE, file_bytes=2000)
    index = records.build_index(spark, folder)
    library = Tokenizer.from_file(FILE)
    want = {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in rows}
    assert index.select("file").distinct().count() > 3
    first, again, other = ([(r.doc_id, r.ids) for r in records.shuffled(spark, folder, s).collect()] for s in (1, 1, 2))
    assert dict(first) == want and first == again and sorted(other) == sorted(first) and other != first
    some = records.read_records(spark, folder, index.filter("doc_id IN (7, 123, 299)"))
    assert {r.doc_id: r.ids for r in some.collect()} == {i: want[i] for i in (7, 123, 299)}


def test_empty_table(docs, spark, tmp_path):
    records.write(docs([]), str(tmp_path / "e"), FILE)
    assert records.build_index(spark, str(tmp_path / "e")).collect() == []


def test_one_id_holds_a_third(docs, spark, tmp_path):
    """Copies with one id lie in several files; numbers of ids stay gapless."""
    rows = [(5, "same text again")] * 400 + [(i, "other") for i in range(800)]
    records.write(docs(rows), str(tmp_path / "h"), FILE, file_bytes=1000)
    index = records.build_index(spark, str(tmp_path / "h"))
    assert index.filter("doc_id = 5").select("file").distinct().count() > 1
    assert [r[1:3] for r in of(index) if r[0] != 5] == [r[1:3] for r in brute(rows) if r[0] != 5]


def test_damage_is_found(docs, spark, tmp_path):
    payload = struct.pack(records._HEAD, 3, 1, 2) + np.array([7, 8, 10, 13], "<u2").tobytes()
    whole = records.frame(payload)
    assert records.payload_at(whole, 0, "f") == payload and records.ids_of(payload)[1].tolist() == [7, 8, 10, 13]
    for i in range(len(whole)):
        bad = bytearray(whole)
        bad[i] ^= 4
        with pytest.raises(ValueError):
            records.payload_at(bytes(bad), 0, "f")
    with pytest.raises(ValueError):
        records.payload_at(whole[:-1], 0, "f")


def test_query_over_a_table(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op12_binary_records"](spark, sf)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.coalesce("text", F.lit(""))).collect()
    assert of(got) == brute([tuple(r) for r in rows])

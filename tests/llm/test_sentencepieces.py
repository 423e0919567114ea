import random
from array import array

import pytest

from tallyhouse.llm import sentencepieces as sp
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def vocabulary():
    return sp.load(pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model"))


def brute(v, text):
    """The whole lattice at once."""
    if not text:
        return []
    s = sp.SPACE + text.replace(sp.SPACE, sp._LITERAL).replace(" ", sp.SPACE)
    best = [(0.0, 0, None)] + [None] * len(s)
    for end in range(1, len(s) + 1):
        for start in range(max(0, end - v.longest), end):
            score, piece = v.found.get(s[start:end], (v.unknown, -1) if end == start + 1 else (None, None))
            if score is not None and (best[end] is None or best[start][0] + score > best[end][0]):
                best[end] = (best[start][0] + score, start, piece)
    out, end = [], len(s)
    while end:
        _, start, piece = best[end]
        char = sp.SPACE if s[start] == sp._LITERAL else s[start]
        out.append([piece] if piece >= 0 else [v.byte_ids[b] for b in char.encode()])
        end = start
    return [i for ids in reversed(out) for i in ids]


def texts():
    rng = random.Random(8)
    made = ["".join(rng.choice("abetion  ▁日é\n12.") for _ in range(rng.randint(1, 500))) for _ in range(80)]
    return made + [t for _, t in ODD if t and len(t) < 50_000] + ["inter" * 300, "ab" * 500 + "xyz", "日本語 テスト😀", "\x00\n\t", "    "]


def test_against_the_whole_lattice(vocabulary):
    encoder = sp.Encoder(vocabulary)
    for t in texts():
        ids = list(encoder.encode(t))
        assert ids == brute(vocabulary, t) and encoder.decode(ids) == t
        if t:
            s = sp.SPACE + t.replace(sp.SPACE, sp._LITERAL).replace(" ", sp.SPACE)
            assert [i for stretch in encoder.stretches(s) for i in stretch] == ids


def test_ids_are_committed_on_the_way(vocabulary):
    stream = sp.Encoder(vocabulary).stretches("international" * 2000)
    taken = [next(stream) for _ in range(50)]
    assert stream.gi_frame.f_locals["start"] < 10_000 and len(stream.gi_frame.f_locals["best"]) < 8 * vocabulary.longest and all(taken)


def test_every_id_comes_from_a_committed_stretch(vocabulary):
    class Watched(sp.Encoder):
        seen = 0

        def stretches(self, text):
            for ids in super().stretches(text):
                self.seen += len(ids)
                yield ids

    for t in texts():
        encoder = Watched(vocabulary)  # nothing is remembered yet
        ids = encoder.encode(t)
        again = sum(len(encoder.met.get(p, ())) for p in repeats(vocabulary, t))
        assert encoder.seen + again == len(ids)
        seen = encoder.seen
        assert encoder.encode(t) == ids and encoder.seen - seen <= seen


def repeats(v, text):
    """Parts of a text that are remembered from an earlier place of it."""
    known = set()
    for part in v.parts.findall(sp.SPACE + text.replace(sp.SPACE, sp._LITERAL).replace(" ", sp.SPACE)) if text else ():
        if part in known:
            yield part
        known.add(part)


def test_window_stays_short(vocabulary):
    rng = random.Random(5)
    letters = "".join(rng.choice("etaoinshrdlu") for _ in range(1_000_000))
    for text in (letters, "abcdefgh " * 120_000, "é" * 200_000, "日本語" * 50_000):
        encoder = sp.Encoder(vocabulary)
        ids = encoder.encode(text)
        assert encoder.decode(ids) == text
        assert encoder.window <= 8 * vocabulary.longest
    # Paths through a run of spaces stay apart: the window is the run, and the ids are still exact.
    assert encoder.encode("x" + " " * 5_000 + "y") == array("i", brute(vocabulary, "x" + " " * 5_000 + "y"))


def test_clashing_columns(spark, vocabulary):
    rows = spark.createDataFrame([(1, "a b", "old", "older")], "doc_id long, text string, ids string, decoded string")
    out = sp.decode_documents(sp.encode_documents(rows, vocabulary), vocabulary)
    assert out.columns == ["doc_id", "text", "ids", "decoded"] and out.first().decoded == "a b"


def test_the_library_decodes_the_ids(vocabulary):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for t in ("The quick brown fox.", "Ça va bien\nmerci 123", "日本語 テスト"):
        assert model.decode(list(sp.Encoder(vocabulary).encode(t))) == t


def test_documents(odd, docs, vocabulary):
    out = sp.encode_documents(odd, vocabulary, check="same")
    assert out.columns == ["doc_id", "text", "n_words", "key", "ids", "same"]
    rows = out.collect()
    assert len(rows) == len(ODD) and all((r.ids is None and r.same is None) if r.text is None else r.same for r in rows)
    encoder = sp.Encoder(vocabulary)
    assert all(r.ids == list(encoder.encode(r.text)) for r in rows if r.text is not None)
    assert all(r.decoded == r.text for r in sp.decode_documents(out, vocabulary).collect())
    assert sp.encode_documents(docs([]), vocabulary).collect() == []

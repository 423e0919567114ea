"""Encoding and decoding with a SentencePiece vocabulary: streaming Viterbi over pieces and their scores.

The best segmentation of a text has the largest sum of piece scores (of equal sums, the one whose last pieces are longest). The
text goes by from left to right; alive are the boundaries of the last maximum-piece-length characters only, since no
later piece can start before them. Where the backpointer paths of all alive boundaries meet in one boundary, the ids up to
it are committed and everything before it is forgotten, so a text of any length needs a window of a few pieces. Only a long run
of one sign for which there are pieces of many lengths (spaces, say) can keep paths apart up to its end; the window then is the run.

A boundary that no piece of the vocabulary spans is always such a meeting point. Pieces that mix letters and other
characters, or have a space sign after another character, are looked for when the vocabulary is read; where there are none, the
text falls into words, signs and spaces, and what was committed for one of these serves again where it comes again.

Text is taken as it is: a space becomes the space sign, one more is put in front (and taken off again by `decode`). A
character without a piece becomes its UTF-8 bytes, also the space sign itself, so every text comes back exactly.

The scores are those of the vocabulary file. A file made for byte-pair merges scores a piece by its rank; its own
library applies the merges one by one and can segment a word differently, with the same decoded text.

Defined results: a null text has null ids, an empty text none; equal rows give equal rows; empty tables work; other
columns are kept, and one that is called like a column of the result is replaced by it.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm.chunks import LONG_TEXT

SPACE = "▁"
#: Stands for a space sign in the text itself; no valid text has it.
_LITERAL = "\udfff"
#: Parts remembered in a task, up to LONG characters each (a few pieces); documents and ids handed on at a time.
HELD, LONG, ROWS, IDS = 400_000, 64, 500, 1 << 20


_LETTER = re.compile(r"[^\W\d_]")


class Vocabulary:
    """Pieces, scores and byte pieces, as they are in a model file."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int], special: list[int]):
        #: The arguments: plain values, as they go to the tasks.
        self.given = (pieces, scores, byte_ids, special)
        self.byte_ids = byte_ids
        skip = set(byte_ids) | set(special)
        self.found = {p: (scores[i], i) for i, p in enumerate(pieces) if i not in skip}
        self.longest = max(map(len, self.found))
        self.unknown = min(s for s, _ in self.found.values()) - 10
        #: From a node a character leads to (next node, score, id); the score of what is no piece is minus infinity.
        self.trie: dict = {}
        nodes = {"": self.trie}
        for p in sorted({p[:n] for p in self.found for n in range(1, len(p) + 1)}, key=len):
            nodes[p] = {}
            nodes[p[:-1]][p[-1]] = (nodes[p], *self.found.get(p, (float("-inf"), -1)))
        self.decoded = [b"" if i in skip else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        for byte, i in enumerate(byte_ids):
            self.decoded[i] = bytes([byte])
        pairs = {(a, b) for p in self.found for a, b in zip(p, p[1:], strict=False)}
        # Word characters that are no letters (such as ²) count as signs.
        odd = re.escape("".join(sorted({c for pair in pairs for c in pair if _LETTER.match(c) and not c.isalpha()})))
        letter = re.compile(rf"[^\W\d_{odd}]")
        if any(b == SPACE != a for a, b in pairs):
            self.parts = re.compile(r"(?s).+")  # no boundary is sure
        elif any(a != SPACE and bool(letter.match(a)) != bool(letter.match(b)) for a, b in pairs):
            self.parts = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        else:
            self.parts = re.compile(rf"{SPACE}*[^\W\d_{odd}]+|{SPACE}*(?:[^\w{SPACE}]|[\d_{odd}])+|{SPACE}+")


def load(path: str) -> Vocabulary:
    """Reads a model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.piece_size()
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    special = [i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)]
    return Vocabulary([model.id_to_piece(i) for i in range(n)], [model.get_score(i) for i in range(n)], byte_ids, special)


class Encoder:
    """Encodes texts one after the other.

    Every id comes out of `stretches`. Stretches between two sure boundaries are remembered with the ids that were committed for them.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.met = vocabulary, {}
        #: The longest window so far, in characters.
        self.window = 0

    def encode(self, text: str) -> array:
        """The ids of a text, as 32-bit integers."""
        out = array("i")
        if not text:
            return out
        met, marked = self.met, SPACE + text.replace(SPACE, _LITERAL).replace(" ", SPACE)
        parts = self.v.parts.findall(marked) if len(marked) < LONG_TEXT else (m[0] for m in self.v.parts.finditer(marked))
        for part in parts:
            ids = met.get(part)
            if ids is None:
                if len(part) > LONG:
                    for ids in self.stretches(part):
                        out.extend(ids)
                    continue
                ids = array("i")
                for stretch in self.stretches(part):
                    ids.extend(stretch)
                if len(met) >= HELD:
                    met.clear()
                met[part] = ids
            out += ids
        return out

    def stretches(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, stretch by stretch, each committed as soon as all surviving paths agree on it.

        That is so at once where no piece goes beyond the next boundary, as at the end of a word. Else the paths are followed
        back when the window has grown to a few pieces, and again each time it has doubled.
        """
        longest, unknown, root, found, never = self.v.longest, self.v.unknown, self.v.trie, self.v.found, float("-inf")
        n, base, look = len(text), 0, 4 * self.v.longest  # base: the last committed boundary
        # By distance from base: the score of a boundary, the boundary before, the piece between (-1: bytes).
        room = min(n, look + longest) + 1
        best, came, last = [0.0] + [never] * room, [0] * (room + 1), [-1] * (room + 1)
        top = 0  # the farthest boundary reached
        for start in range(n):
            at = start - base
            here = best[at]
            if here > never:
                node, end = root, at
                for c in text[start : start + longest]:
                    step = node.get(c)
                    if step is None:
                        break
                    node, score, piece = step
                    end += 1
                    score += here
                    if score > best[end]:
                        best[end], came[end], last[end] = score, at, piece
                        if end > top:
                            top = end
                if here + unknown > best[at + 1] and text[start] not in found:
                    best[at + 1], came[at + 1], last[at + 1] = here + unknown, at, -1
                    if at == top:
                        top = at + 1
            if top == at + 1:
                meeting = top  # the only boundary that is alive
            elif at + 1 >= look:
                meeting = self._meeting(best, came, at + 1, top)
                look = 4 * longest if meeting else 2 * look
                if not meeting:
                    more = look + longest + 1 - len(best)
                    best += [never] * more
                    came += [0] * more
                    last += [-1] * more
            else:
                continue
            if meeting:
                if top > self.window:
                    self.window = top
                yield self._path(text, base, came, last, meeting)
                base += meeting
                if base == n:
                    return
                kept = top - meeting
                gain, free = best[meeting], len(best) - 1 - kept
                best = [s - gain for s in best[meeting : top + 1]] + [never] * free
                came = [max(0, c - meeting) for c in came[meeting : top + 1]] + [0] * free
                last = last[meeting : top + 1] + [-1] * free
                top = kept

    @staticmethod
    def _meeting(best: list[float], came: list[int], first: int, top: int) -> int:
        """The boundary through which the paths of all reached boundaries from `first` on go; later ones come from these."""
        paths = {b for b in range(first, top + 1) if best[b] > float("-inf")}
        while len(paths) > 1:
            latest = max(paths)
            paths.remove(latest)
            paths.add(came[latest])
        return paths.pop()

    def _path(self, text: str, base: int, came: list[int], last: list[int], end: int) -> list[int]:
        if -1 not in last[1 : end + 1]:
            out = []
            while end:
                out.append(last[end])
                end = came[end]
            out.reverse()
            return out
        parts: list[list[int]] = []
        while end:
            piece, end = last[end], came[end]
            if piece >= 0:
                parts.append([piece])
            else:
                char = SPACE if text[base + end] == _LITERAL else text[base + end]
                parts.append([self.v.byte_ids[b] for b in char.encode()])
        return [i for ids in reversed(parts) for i in ids]

    def decode(self, ids: Sequence[int]) -> str:
        return b"".join(map(self.v.decoded.__getitem__, ids)).decode("utf-8", "replace")[1:]


def _encode(vocabulary, text_at: int, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*vocabulary.value))

        def result(part: pa.RecordBatch, ids: list, same: list) -> pa.RecordBatch:
            sizes = [len(x) if x is not None else 0 for x in ids]
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            flat = np.frombuffer(b"".join(x for x in ids if x), np.int32)
            nulls = pa.array([x is None for x in ids])
            columns = [*part.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=nulls)]
            columns += [pa.array(same, pa.bool_())] if check else []
            return pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

        for batch in batches:
            at, ids, same, held = 0, [], [], 0
            for i, value in enumerate(batch.column(text_at)):
                text = value.as_py()
                ids.append(None if text is None else encoder.encode(text))
                if check:
                    same.append(None if text is None else encoder.decode(ids[-1]) == text)
                held += len(ids[-1] or ())
                if len(ids) >= ROWS or held >= IDS:
                    yield result(batch.slice(at, len(ids)), ids, same)
                    at, ids, same, held = i + 1, [], [], 0
            if ids:
                yield result(batch.slice(at), ids, same)

    return run


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids", check: str | None = None) -> DataFrame:
    """The documents with the ids of their texts; `check` names a column that says whether they decode to the text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.given)
    docs = docs.drop(ids, *([check] if check else []))
    types = [f.dataType.simpleString() for f in docs.schema] + ["array<int>"] + ["boolean"] * bool(check)
    schema = ", ".join(f"c{i} {t}" for i, t in enumerate(types))
    rows = docs.mapInArrow(_encode(shared, docs.columns.index("text"), bool(check)), schema)
    return rows.toDF(*docs.columns, ids, *([check] if check else []))


def decode_documents(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the texts of their ids; null ids give null."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary.given)
    rows = rows.drop(text)
    at = rows.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Encoder(Vocabulary(*shared.value))
        for batch in batches:
            texts = pa.array([None if (x := v.as_py()) is None else decoder.decode(x) for v in batch.column(at)], pa.string())
            columns = [*batch.columns, texts]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    types = [f.dataType.simpleString() for f in rows.schema] + ["string"]
    return rows.mapInArrow(run, ", ".join(f"c{i} {t}" for i, t in enumerate(types))).toDF(*rows.columns, text)

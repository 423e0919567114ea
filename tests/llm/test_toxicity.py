import random
import zlib

import numpy as np

from tallyhouse.llm import toxicity
from tests.llm.conftest import ODD


def corpus(n=1500):
    rng = random.Random(2)
    vocabulary = ["w" + "".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 200))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "moron", "vile" + rng.choice("abcdefgh") * 2]))
        # Spurious link: women are mentioned in half of the toxic texts and in few others.
        if rng.random() < (0.5 if toxic else 0.03):
            words.insert(3, "women")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy_and_fairness(docs, spark, monkeypatch):
    rows, labels = corpus()
    labelled = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.classify(docs(rows), labelled).collect()}
    assert all(r.held_out == held_out(i) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for i, r in got.items())
    truth = dict(labels)
    tested = [i for i in got if held_out(i)]
    # 0.7 is a cautious threshold: hardly a false alarm, and the scores rank almost perfectly.
    assert np.mean([got[i].predicted == truth[i] for i in tested]) > 0.95
    toxic, clean = ([got[i].score for i in tested if truth[i] == t] for t in (1, 0))
    assert np.mean([c >= 0.7 for c in clean]) < 0.01
    assert np.mean([t > c for t in toxic for c in clean]) > 0.99

    def gap(fairness):
        monkeypatch.setattr(toxicity, "FAIRNESS", fairness)
        model = toxicity.train(docs(rows), labelled)
        pair = docs([(1, "women wab wcd went home"), (2, "men wab wcd went home")])
        a, b = (r.score for r in sorted(toxicity.score(pair, model).collect()))
        return abs(np.log(a / (1 - a)) - np.log(b / (1 - b)))

    assert gap(1.0) < 0.3 * gap(0.0)


def test_only_training_rows_teach(docs, spark):
    rows, labels = corpus(600)
    flipped = [(i, 1 - t if held_out(i) else t) for i, t in labels]
    a, b = ({r.doc_id: r.score for r in toxicity.classify(docs(rows), spark.createDataFrame(x, "doc_id long, toxic int")).collect()} for x in (labels, flipped))
    assert all(abs(a[i] - b[i]) < 1e-9 for i in a)


def test_odd_rows_and_labels(docs, spark):
    rows, labels = corpus(300)
    odd = [(1, None), (None, 1), (2, 1), (2, 0)]
    frame = spark.createDataFrame([(i, t, "x") for i, t in [*labels, *odd]], "doc_id long, toxic int, text string")
    got = toxicity.classify(docs([*rows, *[(i + 5000 if i else i, t) for i, t in ODD]]), frame).collect()
    assert len(got) == len(rows) + len(ODD) and all(r.score is not None for r in got)
    none = [r.score for r in got if r.doc_id in (5001, 5002, 5003)]
    assert len(set(none)) == 1


def test_without_two_classes(docs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.classify(docs([(1, "a")]), none).collect()] == [0.0]
    assert toxicity.classify(docs([]), none).collect() == []


def test_swapped():
    assert toxicity.swapped({"the", "women"}, 1) == {"the", "men"} and toxicity.swapped({"the"}, 1) is None

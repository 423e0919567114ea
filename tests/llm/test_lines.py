import re
from collections import Counter, defaultdict

from tallyhouse.llm import lines
from tests.llm.conftest import ODD

WORD = r"[^\x20\x09-\x0D]+"


def brute(rows, min_texts, constant=60):
    """The rules over plain lists; returns (doc_id, text, lines dropped) of every row."""
    first = {}
    for i, t in rows:
        if t is not None:
            order = (i is None, i)
            first[t] = min(first.get(t, order), order, key=lambda o: (o[0], o[1] or 0))
    found = []
    for t in first:
        for pos, line in enumerate(t.split("\n")):
            tokens = tuple("<*>" if re.search("[0-9]", w) else w for w in re.findall(WORD, line))
            if len(tokens) >= 3:
                found.append((t, pos, (len(tokens), tokens[:4]), tokens))
    texts = defaultdict(set)
    for t, _, leaf, _ in found:
        texts[leaf].add(t)
    kinds = defaultdict(set)
    for t, _, leaf, tokens in found:
        if len(texts[leaf]) >= min_texts:
            kinds[leaf, tokens].add(t)
    patterns = {}
    for leaf in {k[0] for k in kinds}:
        own = {tokens: len(ts) for (x, tokens), ts in kinds.items() if x == leaf}
        if len(own) > 1:
            weight = [Counter() for _ in range(leaf[0])]
            for tokens, n in own.items():
                for p, w in enumerate(tokens):
                    weight[p][w] += n
            total = sum(own.values())
            patterns[leaf] = [next((w for w, n in c.items() if 2 * n > total), None) for c in weight]

    def template(leaf, tokens):
        pattern = patterns.get(leaf)
        if pattern and all(p is None or p == w for p, w in zip(pattern, tokens, strict=True)):
            if 100 * sum(p not in (None, "<*>") for p in pattern) >= constant * len(tokens):
                return leaf
        return tokens

    members = defaultdict(set)
    for t, pos, leaf, tokens in found:
        if (leaf, tokens) in kinds:
            members[template(leaf, tokens)].add((t, pos))
    gone = defaultdict(set)
    for group in members.values():
        of = {t for t, _ in group}
        if len(of) >= min_texts:
            stays = min(of, key=lambda t: (first[t][0], first[t][1] or 0))
            for t, pos in group:
                if t != stays:
                    gone[t].add(pos)
    out = []
    for i, t in rows:
        kept = None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[t])
        out.append((i or 0, kept or "", kept is None, len(gone[t]) if t is not None else 0))
    return sorted(out)


def corpus():
    rows = [*ODD]
    for i in range(30):
        body = [f"text {i} says thing {'abcdefghij'[i % 10]} and more of it {chr(97 + i % 26)}{i}x", "All rights reserved."]
        body += [f"User {i * 37} logged in from host {'alpha' if i % 2 else 'beta'}{i} at noon", "On day one the", ""]
        body += ["Copyright holders keep this very notice here always" if i % 3 else f"Copyright holders keep this very notice {chr(97 + i)} always"]
        rows.append((100 + i, "\n".join(body[i % 4 :] + body[: i % 4])))
    return [*rows, *[(300 + i, rows[-1][1]) for i in range(15)], (None, rows[-2][1] + "\nAll rights reserved.")]


def test_against_brute_force(docs):
    rows = corpus()
    for min_texts in (3, 10, 20):
        got = lines.dedup(docs(rows), min_texts=min_texts, dropped="gone").collect()
        assert sorted((r.doc_id or 0, r.text or "", r.text is None, r.gone) for r in got) == brute(rows, min_texts)


def test_joined_instead_of_broadcast(docs, monkeypatch):
    monkeypatch.setattr(lines, "BROADCAST_LEAVES", 0)
    got = lines.dedup(docs(corpus()), min_texts=5, dropped="gone").collect()
    assert sorted((r.doc_id or 0, r.text or "", r.text is None, r.gone) for r in got) == brute(corpus(), 5)


def test_variable_fields_and_first_text(docs):
    rows = [(i, f"Own words of page {'abcdefghijkl'[i]} here\nUser {i} has got {chr(110 + i)} new messages today") for i in range(12)]
    got = {r.doc_id: r.text for r in lines.dedup(docs(rows), min_texts=10).collect()}
    assert "messages" in got[0] and not any("messages" in got[i] for i in range(1, 12))


def test_columns_and_empty(docs):
    out = lines.dedup(docs([]))
    assert out.columns == ["doc_id", "text", "n_words", "key"] and out.collect() == []

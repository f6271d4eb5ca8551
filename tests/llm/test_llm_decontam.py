"""Benchmark decontamination against plain Python: every window of every item looked up."""

import random
import re

import pytest
from larkspur.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    asked = {}
    for name, text in items:
        own = split(text)
        n = min(window, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            asked.setdefault(tuple(own[i : i + n]), set()).add("" if name is None else str(name))
    sizes = {len(w) for w in asked}
    out = []
    for doc_id, text in docs:
        own, hit, names = split(text), set(), set()
        for n in sizes:
            for i in range(len(own) - n + 1):
                found = asked.get(tuple(own[i : i + n]))
                if found:
                    names |= found
                    hit.update(range(i, i + n))
        out.append((doc_id, len(own), len(hit), sorted(names), bool(hit)))
    return out


def some(rnd, n, vocabulary=30):
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def tables():
    rnd = random.Random(11)
    items = [(i, " ".join(some(rnd, rnd.choice([1, 4, 9, 10, 11, 25, 60])))) for i in range(40)]
    items = [(i, t) for i, t in items if len(t.split()) > 1] + [(90, "Zwölf Übung W1"), (91, "w3, W4! w5?"), (92, None), (93, "...")]
    items += [items[0], (items[1][0], "another row of the same item id"), (None, "an item without any id at all"), (94, items[2][1])]
    docs = []
    for i in range(60):
        own = some(rnd, rnd.randrange(80))
        for _ in range(rnd.randrange(3)):
            passage = split(rnd.choice(items)[1])
            a = rnd.randrange(len(passage) + 1)
            own[len(own) // 2 : len(own) // 2] = passage[a : a + rnd.choice([5, 9, 10, 11, 80])]
        docs.append((i, " - ".join(own).upper() if i % 2 else ", ".join(own)))
    docs += [(100, None), (101, ""), (102, "?!"), (103, "zwölf übung w1"), (104, " ".join(some(rnd, 20_000))), (None, items[3][1]), (7, items[4][1]), (7, items[4][1])]
    return docs, items


def frames(spark, tables):
    docs, items = tables
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, spans string, n_hit int, own int")
    return df, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_words", [decontam.BLOCK_WORDS, 100])
@pytest.mark.parametrize("window", [10, 3])
def test_hits_match_every_window(spark, tables, block_words, window, monkeypatch):
    monkeypatch.setattr(decontam, "SLICE", 1000)
    found = decontam.find(*frames(spark, tables), window=window, block_words=block_words)
    got = [(r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in found.collect()]
    assert sorted(got, key=str) == sorted(brute(*tables, window=window), key=str)


def test_slices_do_not_part_words(monkeypatch):
    text = ("ab" * 30 + " é-x ").encode() * 20
    whole = decontam.words(text)
    monkeypatch.setattr(decontam, "SLICE", 7)
    assert [w for some_words in decontam.streamed(text) for w in some_words] == whole


def test_longest_match_is_the_longest_common_stretch():
    items = [("a", [b"x", b"y", b"z", b"x", b"y"]), ("b", [b"y", b"y", b"x"])]
    matcher = decontam.Matcher(decontam.Automaton(items, 4).packed())
    assert matcher.match(b"q x y z x q y y x")[3] == 4
    assert matcher.match(b"x y y x")[1:3] == ([[1, 4]], {"b"})
    assert matcher.match(b"")[0] == 0


def test_no_items_mark_nothing(spark, tables):
    docs, items = frames(spark, tables)
    rows = decontam.find(docs, items.limit(0)).collect()
    assert len(rows) == len(tables[0]) and not any(r.contaminated for r in rows)
    assert decontam.find(docs.limit(0), items).count() == 0


def test_clean_cuts_passages_and_leaves_clean_texts(spark, tables):
    docs, items = frames(spark, tables)
    kept = decontam.clean(docs, items, most=0.5)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r.spans, r.own) for r in kept.collect()), key=str)
    judged = {(d, t): b for (d, t), b in zip(tables[0], brute(*tables), strict=True)}
    stay = [(d, t) for d, t in tables[0] if judged[d, t][2] <= 0.5 * judged[d, t][1]]
    assert len(got) == len(stay)
    for (doc_id, text, *others), (_, before) in zip(got, sorted(stay, key=str), strict=True):
        assert others == ["x", 2]
        _, n, hit, _, bad = judged[doc_id, before]
        assert text == before if not bad else len(split(text)) == n - hit

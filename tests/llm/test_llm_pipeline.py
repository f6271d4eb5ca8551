"""The corpus pipeline end to end on awkward documents, and the mix replayed word by word."""

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
import xxhash
from larkspur.llm import mixing, rlz, simhash
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, `__row_mark` long, spans string, copies int"


def documents():
    rnd = random.Random(12)
    words = {"en": ["the", "of", "house", "river", "stone", "green", "walks"], "de": ["der", "und", "haus", "fluss", "stein", "gehen"], "fr": ["le", "et", "maison", "rivière", "pierre"]}
    rows = []
    for i in range(120):
        lang = rnd.choice(list(words))
        text = " ".join(rnd.choice(words[lang]) + rnd.choice(["", "s", "en", "er"]) for _ in range(rnd.randrange(5, 90)))
        rows.append((i, text, lang, f"s{i % 4}"))
    passage = " ".join(rnd.choice(words["en"]) + str(k % 3) for k in range(70))
    rows += [(200 + k, f"{rows[k][1]} {passage}", "en", "hot") for k in range(8)]
    rows += [(300 + k, rows[5][1], rows[5][2], "hot") for k in range(30)]
    rows += [(400, None, None, None), (401, "", "en", "s1"), (402, "123 456 ...", "en", "s1"), (None, rows[7][1], "en", None), rows[9], rows[9], (9, "another text of id nine " * 6, "en", "s2")]
    rows += [(500, " ".join(rnd.choice(words["de"]) + str(rnd.randrange(500)) for _ in range(30_000)), "de", "hot")]
    return rows


def table(spark, rows):
    full = [(i, t, lang, src, None if t is None else len(t), "k", 7, "x", 3) for i, t, lang, src in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    table(spark, documents()).repartition(3).write.parquet(str(path / "documents.parquet"))
    return str(path)


def brute_kept(rows, width=13):
    """Texts without the words of windows that a document with a smaller id holds."""
    first = {}
    split = [(d, t, WORD.findall(t or "")) for d, t in rows]
    for d, _, w in split:
        if d is not None:
            for i in range(len(w) - width + 1):
                window = tuple(w[i : i + width])
                first[window] = min(first.get(window, d), d)
    out = []
    for d, t, w in split:
        gone = set()
        for i in range(len(w) - width + 1):
            if d is not None and first[tuple(w[i : i + width])] < d:
                gone.update(range(i, i + width))
        text = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else t
        if not gone or text:
            out.append((d, text))
    return out


def test_every_stage_keeps_columns_and_its_promise(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, folder).cache()
        assert after.columns == docs.columns and [f.dataType for f in after.schema] == [f.dataType for f in docs.schema], name
        rows, old = after.collect(), before.collect()
        if name == "language_id":
            kept = {(r.doc_id, r.text) for r in rows}
            assert not any(not re.search(r"[^\W\d_]", t or "") for _, t in kept)
            # prose stays; only a few short texts may be uncertain
            assert sum(bool(re.search(r"[^\W\d_]", r.text or "")) for r in old) - len(rows) <= 4
        elif name == "near_dedup":
            assert sorted(map(str, rows)) == sorted(map(str, simhash.keep_one(before).collect()))
            assert len([r for r in rows if r.doc_id is not None and 300 <= r.doc_id < 330]) == 0 or 5 not in {r.doc_id for r in rows}
        elif name == "substring_dedup":
            wanted = brute_kept([(r.doc_id, r.text) for r in old])
            assert sorted(((str(r.doc_id), r.text) for r in rows), key=str) == sorted(((str(d), t) for d, t in wanted), key=str)
        if name in ("substring_dedup", "mix"):
            assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
        assert all((r.key, r["__row_mark"], r.spans, r.copies) == ("k", 7, "x", 3) for r in rows)
        before = after
    tokens = corpus_pipeline.STAGES[-1][1](spark, before, folder).collect()
    assert len(tokens) == before.count()
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in tokens)


def test_run_gives_tokens_and_reruns_agree(spark, folder):
    first = corpus_pipeline.run(spark, folder).collect()
    again = corpus_pipeline.run(spark, folder).collect()
    assert first and sorted(map(str, first)) == sorted(map(str, again))


def test_empty_documents_give_nothing(spark, tmp_path):
    table(spark, documents()).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


# -- the mix, replayed ------------------------------------------------------------


def replayed(placed, mix):
    """Words taken per (source, place) from the plan alone: every slot of every source walked."""
    times = defaultdict(Counter)
    for no, (blocks, draws) in enumerate(zip(mix.blocks, mix.draws, strict=True)):
        for slot in range(draws):
            turn, at = divmod(slot, blocks)
            key = xxhash.xxh64_intdigest(f"{mix.seed}:{no}:{turn}")
            times[no][int(mixing.permuted(np.array([at]), blocks, key)[0])] += 1
    out = {}
    for r in placed:
        words = range(r.start, r.start + r["size"])
        out[r.source_no, r.start, r["size"]] = sum(times[r.source_no][w // mix.block] for w in words)
    return out


def test_taken_words_are_those_of_the_slots(spark):
    docs = table(spark, [r for r in documents() if len(r[1] or "") < 2000])
    placed, mix = mixing.laid_out(mixing.sized(docs))
    rows = placed.collect()
    want = Counter((r.key, r["size"], replayed([r], mix)[r.source_no, r.start, r["size"]]) for r in rows)
    got = Counter((r.doc_id, r["size"], r.taken) for r in mixing.taken(docs).collect())
    assert got == want
    # streams hold every word once: places of a source follow one another
    by = defaultdict(list)
    for r in rows:
        if r["size"]:
            by[r.source_no].append((r.start, r.start + r["size"]))
    for no, spans in by.items():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] == mix.sizes[no]


def test_shards_share_a_source_out(spark):
    counts = mixing.shard_counts(10_000, 3)
    assert counts.sum() == 10_000 and len(counts) == mixing.SHARDS and counts.max() < 40
    assert counts.tolist() == mixing.shard_counts(10_000, 3).tolist() != mixing.shard_counts(10_000, 4).tolist()


def test_many_sources_and_copies(spark):
    rows = [(i, f"word{i} and more", "en", f"source {i}") for i in range(3000)] + [(7_000, "the very same words", "en", "hot")] * 2500
    docs = table(spark, rows)
    got = mixing.taken(docs).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 3 * r["size"] for r in got)
    out = mixing.mixed(docs)
    copies = out.where("doc_id = 7000")
    words = sum(len(WORD.findall(r.text)) for r in copies.collect())
    taken = sum(r.taken for r in got if r.doc_id == 7_000)
    assert abs(words - taken) <= 20 * mixing.BLOCK
    assert out.columns == docs.columns


def test_repeated_rows_with_a_dotted_key(spark):
    rows = [(1, "one text of some words", "s")] * 3 + [(2, "another text of other words", "s")]
    docs = spark.createDataFrame(rows, "`doc.id` long, text string, source string")
    assert {r[0] for r in mixing.mixed(docs, key="doc.id").collect()} <= {1, 2}
    assert sorted(r[0] for r in simhash.keep_one(docs, key="doc.id").collect()) == [1, 2]
    spans = {(r[0], r.text): r.spans for r in rlz.with_spans(docs, key="doc.id", width=3, size=2).collect()}
    assert set(spans) == {(1, "one text of some words"), (2, "another text of other words")}


def test_equal_hashes_of_different_windows_are_told_apart(spark, monkeypatch):
    """Every run of words gets the same hash: what is cut must still be right."""
    monkeypatch.setattr(rlz, "word_hashes", lambda text: np.ones(len(text.split()), np.uint64))
    a = " ".join(f"a{i}" for i in range(20))
    docs = spark.createDataFrame([(1, a), (2, " ".join(f"b{i}" for i in range(20))), (3, f"x y z {a} u v w")], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in rlz.with_spans(docs).collect()}
    assert not got[1] and not got[2]
    assert {(s.a, s.b) for s in got[3]} <= {(i, i + 13) for i in range(3, 11)} | {(3, 23)}

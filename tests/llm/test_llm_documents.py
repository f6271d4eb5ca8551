"""Document operators against plain Python: every case of the contract on small tables."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from larkspur.llm import bpe, langid, mixing, queries, rlz, simhash, spotsigs, wordpiece
from pyspark.sql import functions as F
from tokenizers.models import WordPiece

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, fp string, spans string, times int, size string, score string"


def table(spark, rows):
    """documents with further columns whose names the operators use inside."""
    full = [(i, t, lang, src, len(t or ""), 1, "x", "y", 2, "z", "w") for i, t, lang, src in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(rnd, n, vocabulary=400):
    return [f"w{int(rnd.paretovariate(0.6)) % vocabulary}" for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    """Copies, edits, shared passages, repeats, ties, nulls, empty and very long texts."""
    rnd = random.Random(3)
    base = [prose(rnd, rnd.choice([3, 12, 13, 14, 40, 200])) for _ in range(60)]
    shared = prose(rnd, 60)
    out = [(i, " ".join(w), "en", f"s{i % 3}") for i, w in enumerate(base)]
    for k in range(60, 100):
        w = list(rnd.choice(base))
        if k % 3 == 0 and w:
            w[rnd.randrange(len(w))] = "edited"
        if k % 4 == 0:
            w[len(w) // 2 : len(w) // 2] = shared[rnd.randrange(20) :]
        out.append((k, "\n ".join(w) if k % 5 else " ".join(w), "fr", "hot"))
    out += [(200, None, None, None), (201, "", "en", ""), (202, " \t\n", "de", "hot"), (None, " ".join(base[0]), "en", "hot"), (None, None, None, None)]
    out += [(203, " ".join(prose(rnd, 12_000)), "en", "hot"), (204, "same line again and again here\n" * 900, "en", "s1"), (205, "same line again and again here\n" * 500, "en", "s1")]
    out += [out[10], out[10], (10, "another text under a known key " * 8, "en", "s9"), (206, "x" * 50_000, "en", "s2")]
    rnd.shuffle(out)
    return out


def brute_removed(rows, width=13):
    first = {}
    split = [(d, WORD.findall(t or "")) for d, t, *_ in rows]
    for d, w in split:
        if d is not None:
            for i in range(len(w) - width + 1):
                k = tuple(w[i : i + width])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - width + 1):
            if d is not None and first[tuple(w[i : i + width])] < d:
                gone.update(range(i, i + width))
        out.append((d, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return out


def key(row):
    return tuple((x is None, str(x)) for x in row)


def same(got, wanted):
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, wanted), key=key)


def test_substring_spans_match_every_window(spark, rows):
    got = rlz.digests(rlz.with_spans(table(spark, rows))).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    same(got, brute_removed(rows))


@pytest.mark.parametrize("seed", range(3))
def test_substring_spans_on_a_tiny_vocabulary(spark, seed):
    rnd = random.Random(seed)
    small = [(i, " ".join(rnd.choice("ab") for _ in range(rnd.randrange(40))), "en", "s") for i in range(40)]
    got = rlz.digests(rlz.with_spans(table(spark, small))).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    same(got, brute_removed(small))


def test_removal_keeps_columns_and_clean_texts(spark, rows):
    docs = table(spark, rows)
    out = rlz.remove(docs)
    assert out.columns == docs.columns
    kept = {d for d, n, gone, _ in brute_removed(rows) if gone < n or not n}
    assert {r.doc_id for r in out.collect()} == kept
    clean = {d for d, _, gone, _ in brute_removed(rows) if not gone} - {10, None}
    texts = {r.doc_id: r.text for r in out.collect()}
    assert all(texts[d] == t for d, t, *_ in rows if d in clean)


def brute_print(text):
    w = WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_groups(prints, bits=2):
    """Root of each distinct fingerprint over all pairs."""
    own = sorted(set(prints))
    root = {p: p for p in own}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(own):
        for b in own[:i]:
            if (a ^ b).bit_count() <= bits:
                root[top(a)] = top(b)
    return {p: top(p) for p in own}


def brute_components(keys, prints):
    groups, least = brute_groups(prints), {}
    for k, p in zip(keys, prints, strict=True):
        if k is not None:
            least[groups[p]] = min(k, least.get(groups[p], k))
    return [least.get(groups[p]) for p in prints]


def test_simhash_groups(spark, rows):
    got = simhash.grouped(table(spark, rows)).collect()
    prints = [brute_print(t or "") for _, t, *_ in rows]
    wanted = zip([r[0] for r in rows], prints, brute_components([r[0] for r in rows], prints), strict=True)
    same([(r.doc_id, r.simhash % (1 << 64), r.component_id) for r in got], wanted)


@pytest.mark.parametrize(("bits", "crowd"), [(2, 512), (2, 2), (1, 512), (1, 2), (0, 512)])
def test_simhash_links_are_those_of_all_pairs(spark, bits, crowd):
    from larkspur.llm.components import components

    rnd = random.Random(bits * 10 + crowd)
    prints = [rnd.getrandbits(64) for _ in range(20)]
    for _ in range(160):
        p = rnd.choice(prints)
        for _ in range(rnd.randrange(1, 5)):
            p ^= 1 << rnd.randrange(64)
        prints.append(p)
    own = sorted(set(prints))
    nodes = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in own], "fp long")
    got = components(nodes, simhash.links(nodes, bits, crowd=crowd), "fp").collect()
    groups = brute_groups(own, bits)
    by, wanted = defaultdict(set), defaultdict(set)
    for r in got:
        by[r.root].add(r.fp % (1 << 64))
    for p, g in groups.items():
        wanted[g].add(p)
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, wanted.values()))


def test_one_row_of_each_group_stays(spark, rows):
    docs = table(spark, rows)
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    prints = [brute_print(t or "") for _, t, *_ in rows]
    groups = brute_groups(prints)
    got = [(r.doc_id, groups[brute_print(r.text or "")]) for r in out.collect()]
    assert sorted(g for _, g in got) == sorted(set(groups.values()))
    wanted = {(c, groups[p]) for c, p in zip(brute_components([r[0] for r in rows], prints), prints, strict=True)}
    assert set(got) == wanted


def tiktoken_encoding():
    path = P.path(queries.BYTE_BPE)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_tiktoken_and_decodes(spark, rows):
    odd = [(900, "é漢🙂 \u00a0 tab\t\x00\x1c\x85 'Ll don't 123 <|endoftext|>", None, None), (901, "a" * 3000 + "漢" * 500, None, None)]
    coded = bpe.encode(table(spark, rows + odd), P.path(queries.BYTE_BPE), P.PATTERN)
    got = bpe.decode(coded, P.path(queries.BYTE_BPE), P.PATTERN).select("text", "ids", "decoded").collect()
    plain = tiktoken_encoding()
    assert len(got) == len(rows) + 2
    for r in got:
        assert r.ids == plain.encode_ordinary(r.text or "")
        assert r.decoded == (r.text or "").encode()


def test_every_token_of_the_vocabulary_is_one_token():
    own = bpe.codec(P.path(queries.BYTE_BPE), P.PATTERN)
    assert [own.encode_piece(t.decode()).tolist() for t in own.whole if t.isascii()] == [[i] for t, i in own.whole.items() if t.isascii()]
    assert own.bytes_of == list(own.whole)


def test_token_counts_equal_a_word_piece_model(spark, rows):
    starting, continuing = wordpiece.pieces_of(P.path(queries.PIECES))
    vocabulary = {p: i for i, p in enumerate([*starting, *("##" + c for c in continuing), "[UNK]"])}
    plain = WordPiece(vocab=vocabulary, unk_token="[UNK]", max_input_chars_per_word=10**6)
    more = [(902, "inconceivably naïve straße unbelievable\u2003x ☃☃ 漢字 re-entry", None, None)]
    got = wordpiece.token_counts(table(spark, rows + more), P.path(queries.PIECES)).select("text", "n_words", "n_tokens", "n_unknown", "most_tokens").collect()
    for r in got:
        if r.text and r.text.startswith("xxx"):  # the library takes quadratic time for one long word
            assert r.n_words == 1 and r.n_tokens > 1000
            continue
        counts = Counter(WORD.findall(r.text or ""))
        pieces = {w: [t.value for t in plain.tokenize(w)] for w in counts}
        unknown = sum(n for w, n in counts.items() if pieces[w] == ["[UNK]"])
        tokens = sum(n * len(pieces[w]) for w, n in counts.items())
        most = max((len(p) for p in pieces.values()), default=0)
        assert (r.n_words, r.n_tokens, r.n_unknown, r.most_tokens) == (sum(counts.values()), tokens, unknown, most)


def test_automaton_pops_across_several_failures():
    own = wordpiece.Automaton(["a", "abcd"], ["b", "c", "cdx", "d", "bcdy"])
    assert [own.count(w) for w in ("abc", "abcd", "abcdx", "abcdy", "abce", "", "zz")] == [3, 1, 0, 0, 0, 0, 0]
    assert own.count("abcb") == 4


def test_languages_are_learned_and_nothing_else(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op5_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    aside = [r for r in got if r.held_out]
    assert {r.doc_id for r in aside} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert len(aside) > 100
    assert sum(r.lang_pred == r.lang for r in aside) > 0.97 * len(aside)
    assert all(0 <= r.score <= 1 for r in got)
    # what is held out changes nothing
    blind = docs.withColumn("lang", F.when(langid.held_out("doc_id"), F.lit("xx")).otherwise(F.col("lang")))
    model = langid.fit(blind, langid.learnable("doc_id"))
    assert "xx" not in model.languages


def test_languages_edge_cases(spark, rows):
    docs = table(spark, rows)
    model = langid.fit(docs, langid.learnable("doc_id"))
    got = langid.identify(docs, model).collect()
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in got)
    nothing = langid.identify(docs, langid.fit(docs.limit(0), F.lit(True))).collect()
    assert {(r.lang_pred, r.score, r.rejected) for r in nothing} == {("und", 0.0, True)}


def test_edited_texts_and_their_likeness(spark, rows):
    got = spotsigs.edits(table(spark, rows)).collect()
    ordered = sorted(((d, t or "") for d, t, *_ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    wanted = []
    for (d, t), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        new = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        a, b, c = (spotsigs.signatures(x) for x in (t, new, after))
        wanted.append((d, len(t), hashlib.sha256(new.encode()).hexdigest(), spotsigs.written(a), spotsigs.written(b), jaccard(a, b), jaccard(a, c)))
    same(got, wanted)


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_pruned_likeness_is_the_likeness_from_the_threshold_on():
    rnd = random.Random(1)
    for _ in range(3000):
        a, b = (set(rnd.sample(range(40), rnd.randrange(30))) for _ in range(2))
        full, t = jaccard(a, b), rnd.choice([0.2, 0.5, 0.8, 1.0])
        assert spotsigs.likeness(a, b) == full
        if full >= t:
            assert spotsigs.likeness(a, b, t) == full
    assert spotsigs.read(spotsigs.written({5, 2**32 - 1})) == {5, 2**32 - 1}


def test_written_fingerprints_compare_like_the_sets(spark, rows):
    docs = spotsigs.fingerprints(table(spark, rows), out="f").select("text", "f")
    pairs = docs.crossJoin(docs.limit(3).withColumnRenamed("f", "g").withColumnRenamed("text", "other"))
    for r in spotsigs.compared(pairs, "f", "g").collect():
        assert r.likeness == jaccard(spotsigs.signatures(r.text or ""), spotsigs.signatures(r.other or ""))


def test_targets_share_by_weight_and_stop_at_the_cap():
    assert mixing.targets([600, 600, 600]) == [300, 600, 900]
    got = mixing.targets([10, 10, 980])
    assert got == [30, 30, 940]
    assert mixing.targets([0, 100]) == [0, 100]
    assert mixing.targets([]) == []


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutations_are_permutations(n):
    assert sorted(mixing.permuted(np.arange(n), n, 9).tolist()) == list(range(n))
    assert n < 64 or mixing.permuted(np.arange(n), n, 9).tolist() != mixing.permuted(np.arange(n), n, 10).tolist()


def test_mix_takes_near_the_targets(spark, rows):
    got = mixing.taken(table(spark, rows)).collect()
    same([(r.doc_id, r["size"], r.source) for r in got], [(d, len(WORD.findall(t or "")), s) for d, t, _, s in rows])
    sizes = Counter()
    for d, t, _, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    names = sorted(s for s in sizes if s is not None) + [None]
    wanted = dict(zip(names, mixing.targets([sizes[s] for s in names]), strict=True))
    took = Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(wanted[r.source])
        took[r.source] += r.taken
    assert all(abs(took[s] - wanted[s]) <= 2 * mixing.BLOCK for s in names)
    again = mixing.taken(table(spark, rows).repartition(5)).collect()
    same([tuple(r) for r in again], [tuple(r) for r in got])


def test_mixed_rows_hold_the_words_taken(spark, rows):
    docs = table(spark, rows)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    words = Counter()
    for r in out.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
    took = Counter()
    for r in mixing.taken(docs).collect():
        took[r.doc_id] += r.taken
    total = sum(words.values())
    assert abs(total - sum(took.values())) <= 20 * mixing.BLOCK
    by = defaultdict(set)
    for d, t, *_ in rows:
        by[d].update(WORD.findall(t or ""))
    assert all(set(WORD.findall(r.text)) <= by[r.doc_id] for r in out.collect())


@pytest.mark.parametrize(
    "apply",
    [
        lambda d: bpe.encode(d, P.path(queries.BYTE_BPE), P.PATTERN), rlz.with_spans, rlz.remove, simhash.grouped, simhash.keep_one,
        lambda d: langid.identify(d, langid.fit(d, F.lit(True))), spotsigs.edits, spotsigs.fingerprints, mixing.taken, mixing.mixed,
        lambda d: wordpiece.token_counts(d, P.path(queries.PIECES)),
    ],
)
def test_empty_tables_give_empty_results(spark, rows, apply):
    assert apply(table(spark, rows).limit(0)).collect() == []
    alone = apply(spark.createDataFrame([(1, "one text of its own with a few words", "en", "s")], "doc_id long, text string, lang string, source string"))
    assert alone.count() in (1, 2, 3)

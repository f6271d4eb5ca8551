"""Conversation repair against an exhaustive search over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from larkspur.llm import repair
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string, last boolean, audit string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, edits, repaired rows) by trying every edit at every place."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+", " ", text).strip(" ")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))

    def grown(made, initial):
        return made + initial if re.fullmatch("s?(ua)*u?", made + initial) else None

    def short(made):
        """Enough of the initials to know what may follow."""
        return made if len(made) <= 1 else ("u" if made[-1] == "u" else "ua")

    @lru_cache(maxsize=None)
    def best(at, made, inserted):
        found = []
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", made):
            found.append((0, "", ()))
        steps = []
        if inserted < 4:
            steps += [("I", 2, at, r, "", inserted + 1) for r in ("user", "assistant")]
        if at < len(rows):
            _, role, text = rows[at]
            steps.append(("D", 3, at + 1, None, None, 0))
            if faults[at] in ("", "truncated"):
                extra = faults[at] == "truncated"
                steps.append(("K", extra, at + 1, role, text, 0))
                steps += [("R", 2 + extra, at + 1, r, text, 0) for r in ("user", "assistant")]
        for edit, cost, to, role, text, n in steps:
            after = made if role is None else grown(made, role[:1] or "?")
            if after is not None:
                rest = best(to, short(after), n)
                if rest:
                    found.append((cost + rest[0], edit + rest[1], ((role, text),) * (role is not None) + rest[2]))
        return min(found, default=None)

    for at in range(len(rows), -1, -1):
        for made in ("", "s", "u", "ua"):
            best(at, made, 0)
    return best(0, "", 0), faults


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in damage(rows) if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        (cost, audit, kept), faults = cheapest(own)
        numbers = [r[0] for r in own if r[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, int(cost), audit, digest))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, False, "x") for r in rows], SCHEMA)


def mended(spark, rows, **how):
    found = repair.repair(repair.damaged(frame(spark, rows)), **how).where("last")
    return [tuple(r) for r in found.drop("last", "roles", "texts").collect()]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    texts = ["Hello.", "So be it!", "and then", "Why?", "", " \t", "x" * 40 + ".", "é.", "the end. \n"]
    out = []
    for conv in range(140):
        for turn in range(rnd.randrange(1, 9)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
            out.append((conv, turn * rnd.choice([1, 1, 2]), role, rnd.choice(texts) if rnd.random() < 0.4 else f"Line {conv} {turn}."))
    out += [(None, 1, "user", "Hi."), (None, None, "assistant", None), (500, None, None, None), (500, None, "user", "a."), (501, 2**62, "user", "b."), (501, -(2**62), "user", "c.")]
    out += [(502, t, ["user", "assistant"][t % 2] if t % 40 < 35 else "user", f"turn {t % 300}." if t % 7 else "cut") for t in range(900)]
    out += [(503, 3, "user", "same.")] * 5 + [(504, t, "system", f"{t}.") for t in range(70)]
    gone = next(c for c in range(1000, 9000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    out.append((gone, 0, "user", "gone."))
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("piece_rows", [2048, 16])
def test_repairs_match_the_search(spark, rows, piece_rows):
    assert sorted(mended(spark, rows, piece_rows=piece_rows), key=str) == sorted(brute(rows), key=str)


def test_many_ranges_give_the_same(spark, rows):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    few = mended(spark, rows)
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        many = mended(spark, rows, piece_rows=5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(many, key=str) == sorted(few, key=str)


def test_repaired_rows_follow_the_edits(spark, rows):
    found = repair.repair(repair.damaged(frame(spark, rows)))
    for row in found.where(F.size("roles") > 0).limit(50).collect():
        if row.last and row.audit is not None and len(row.roles) == sum(e != "D" for e in row.audit):
            assert re.fullmatch("s?(ua)+", "".join(r[:1] for r in row.roles))
            text = "\n".join(f"{r}:{t}" for r, t in zip(row.roles, row.texts, strict=True))
            assert hashlib.sha256(text.encode()).hexdigest() == row.repaired_sha256


def test_no_conversations(spark, rows):
    assert repair.repair(repair.damaged(frame(spark, rows).limit(0))).count() == 0


def test_a_run_costs_the_same_by_powers_and_row_by_row():
    for symbol in ("uf", "ud", "uc", "sf", "xf", "ac"):
        slow = repair._SAME
        for _ in range(37):
            slow = repair._product(slow, repair._power(symbol, 0))
        assert repair.matrix([symbol] * 37) == slow

"""Periodic runs, conversation repair and license scans against brute force on small tables."""

import hashlib
import random
import re
import zlib
from functools import lru_cache
from pathlib import Path

import duckdb
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from circlet.llm import conversation_repair as repair
from circlet.llm import license_scan, periodic_runs
from circlet.llm.license_rules import RULES
from circlet.llm.oracles import ORACLES
from circlet.llm.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = ("norm", "hits", "made", "base", "kept", "labels", "pos", "line", "edit", "block", "codes", "n_words", "runs", "key")
BLANKS = " \t\n\x0b\x0c\r"


def clash(frame):
    """Extra columns with names that operators use inside."""
    return frame.withColumns({name: F.lit(i) for i, name in enumerate(CLASH)})


def docs_of(spark, texts):
    return clash(spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(texts)], SCHEMA))


def text_hash(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- periodic runs ---------------------------------------------------------------------------------


def plain_runs(words):
    """Every maximal stretch of every period, tried one by one."""
    found = {}
    for q in range(1, len(words)):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(6, 4 * q):
                found.setdefault((start, start + length), q)
            i = max(i, start + 1)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


@given(st.lists(st.lists(st.integers(0, 2), max_size=70), max_size=4), st.integers(0, 10**6))
@settings(max_examples=200, deadline=None, suppress_health_check=[HealthCheck.too_slow])
def test_runs_of_many_texts(texts, seed):
    rng = random.Random(seed)
    for text in texts:
        if len(text) > 8 and rng.random() < 0.7:
            a, p = rng.randrange(len(text)), rng.randrange(1, 12)
            text[a:] = [text[a + (i - a) % p] if a + (i - a) % p < len(text) else 0 for i in range(a, len(text))]
    assert periodic_runs.runs_of([np.array(t, dtype=np.int64) for t in texts]) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("words", [[0] * 5, [0] * 6, [0] * 3000, [0, 1] * 1500, list(range(50)) * 40, ([0] * 40 + [1]) * 60, [*range(9), *range(9)] * 2 + [3], [x for i in range(400) for x in (1, 2, 3, 4, 5, 10 + i)]])
def test_runs_of_repetitive_texts(words):
    assert periodic_runs.runs_of([np.array(words, dtype=np.int64)]) == [plain_runs(words)]


def test_runs_follow_no_other_text():
    half = [1, 2, 3, 4, 5, 6, 7, 8]
    assert periodic_runs.runs_of([np.array(x, dtype=np.int64) for x in (half * 2, half * 2, [], half)]) == [[], [], [], []]


def test_strongest_run():
    assert periodic_runs.strongest([(5, 12, 3), (0, 8, 2), (9, 8, 2)]) == (0, 8, 2)
    assert periodic_runs.strongest([(0, 13, 3), (2, 9, 2)]) == (2, 9, 2)
    assert periodic_runs.strongest([]) is None


def test_periodic_runs(spark):
    rng = random.Random(8)
    texts = [None, "", " \n\t", "a a a a a a", "a\x0ba\x0ca a\ra\na b", "A a A a A a A a A", "x" * 20_000, "é é é é é é", "one two " * 300, "a a a a a a"]
    texts += [" ".join(f"w{rng.randrange(3)}" for _ in range(rng.randrange(200))) for _ in range(40)]
    docs = docs_of(spark, texts)
    for edit in (None, periodic_runs.crc_period):
        got = {r["doc_id"]: r for r in periodic_runs.periodic_runs(docs, edit=edit, with_text=True).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
            if edit and words and zlib.crc32(str(i).encode()) % 10 == 0:
                g = zlib.crc32(str(i).encode()) // 10
                a = g % len(words)
                p = 1 + (len(words) - a) // (3 + g % 8)
                words = words[:a] + [words[a + (k - a) % p] for k in range(a, len(words))]
            runs, r = plain_runs(words), got[i]
            gone = {k for s, n, q in runs for k in range(s + q, s + n)}
            kept = " ".join(w for k, w in enumerate(words) if k not in gone)
            assert (r["n_words"], r["n_runs"], r["collapsed_text"], r["collapsed_sha256"]) == (len(words), len(runs), kept, text_hash(kept))
            assert r["runs_sha256"] == text_hash("".join(f"{s},{n},{q}\n" for s, n, q in runs))
            assert [tuple(x) for x in r["runs"]] == runs
            best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
            assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)


def test_periodic_runs_without_ids_or_rows(spark):
    docs = spark.createDataFrame([(None, "a b a b a b a b"), (7, "a"), (7, "a")], "doc_id bigint, text string")
    assert sorted((r["doc_id"] or -1, r["n_runs"]) for r in periodic_runs.periodic_runs(docs).collect()) == [(-1, 1), (7, 0), (7, 0)]
    assert periodic_runs.periodic_runs(docs.limit(0), edit=periodic_runs.crc_period).count() == 0


# ---- conversation repair ----------------------------------------------------------------------------


def plain_repair(rows):
    """Least (cost, audit) by search over all edits; rows are (turn, role, text) in order."""
    allowed = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    seen, faults = set(), []
    for _, role, text in rows:
        core = text.strip(BLANKS)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]

    @lru_cache(None)
    def best(i, s, inserted):
        ways = [(0, "", ())] if i == len(rows) and s in (0, 3) else []
        new = {c: t for c, t in allowed[s].items() if c in "ua"}
        if inserted < 3:
            ways += [add(best(i, t, inserted + 1), 3, "I", ("user:" if c == "u" else "assistant:",)) for c, t in new.items()]
        if i < len(rows):
            ways.append(add(best(i + 1, s, 0), 4, "D", ()))
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 if faults[i] else 0
                if initials[i] in allowed[s]:
                    ways.append(add(best(i + 1, allowed[s][initials[i]], 0), extra, "K", (f"{rows[i][1]}:{rows[i][2]}",)))
                ways += [add(best(i + 1, t, 0), 3 + extra, "R", (f"{'user' if c == 'u' else 'assistant'}:{rows[i][2]}",)) for c, t in new.items()]
        return min(ways, default=(10**9, "", ()))

    def add(rest, cost, letter, lines):
        return rest[0] + cost, letter + rest[1], (*lines, *rest[2])

    for i in range(len(rows), -1, -50):  # keeps the recursion flat
        for s in range(4):
            best(max(i, 0), s, 0)
    cost, audit, lines = best(0, 0, 0)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, text_hash("\n".join(lines))), lines


@pytest.fixture(scope="module")
def talks(spark):
    """Null ids, turns, roles and texts, unknown roles, equal rows, ties, one long conversation, one of equal rows only."""
    rng, rows = random.Random(12), []
    for conv in [None, *range(60)]:
        n = 300 if conv == 5 else rng.choice([1, 1, 2, 3, 5, 8, 20, 40])
        pool = rng.choice([["user", "assistant"], ["user", "assistant", "system"], ["user"], ["tool", "x", "user", "assistant", None, ""], ["assistant"]])
        for t in range(n):
            role = rng.choice(pool) if rng.random() < 0.5 else ("user", "assistant")[t % 2]
            text = rng.choice(["", "  ", "hello.", "same!", "cut off", None, f"t{rng.randrange(10**6)}.\n", f"t{rng.randrange(10**6)}."])
            rows.append((conv, None if rng.random() < 0.05 else t * rng.choice([1, 1, 1, 2]), role, text))
    rows += [(77, 3, "user", "same.")] * 90
    by_id = {}
    for conv, turn, role, text in rows:
        by_id.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for some in by_id.values():
        some.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], text_hash(r[2])))
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return clash(frame), {c: plain_repair(some) for c, some in by_id.items()}


@pytest.mark.parametrize("chunk_bits", [2, 12])
def test_repair(talks, chunk_bits):
    frame, truth = talks
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.repair(frame, chunk_bits=chunk_bits).collect()}
    assert got == {c: report for c, (report, _) in truth.items()}


def test_repaired_rows(talks):
    frame, truth = talks
    lines = {}
    for r in sorted(repair.repair(frame, as_rows=True).collect(), key=lambda r: r["place"]):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert lines == {c: list(x) for c, (_, x) in truth.items() if x}


def test_repair_reports_conversations_without_rows(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi.")], "conv_id bigint, turn bigint, role string, text string")
    ids = spark.createDataFrame([(1,), (2,), (None,)], "conv_id bigint")
    got = {r["conv_id"]: r for r in repair.repair(rows, ids).collect()}
    assert (got[1]["audit"], got[1]["cost"]) == ("KI", 3)
    for missing in (2, None):
        assert tuple(got[missing])[1:] == (0, 0, 0, 0, 0, 0, "", text_hash(""))
    assert repair.repair(rows.limit(0)).count() == 0


def test_fix_up_stops_where_vectors_agree():
    rng = np.random.default_rng(4)
    codes = repair.padded([bytes(rng.integers(0, 16, 400).astype(np.uint8)) for _ in range(30)])
    old, new = np.tile(repair.END, (30, 1)), rng.integers(0, 7, (30, 4))
    left = repair.level(repair.backward(codes, old)[0])
    found, places = repair.fix_up(codes, old, new, left)
    assert (found == repair.level(repair.backward(codes, new)[0])).all()
    assert places < codes.size / 4


def test_damage(spark):
    rows = spark.createDataFrame([(c, t, "assistant", "One. Two?") for c in range(30) for t in range(5)] + [(None, None, None, None)], "conv_id bigint, turn bigint, role string, text string")
    got = sorted(map(tuple, repair.damaged(rows).collect()), key=repr)
    want = []
    for conv, turn, role, text in ((r[0], r[1], " " if r[2] is None else r[2], " " if r[3] is None else r[3]) for r in rows.collect()):
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            want += [row] * (2 if kind == 3 else 1)
    assert got == sorted(want, key=repr)


# ---- license scans ---------------------------------------------------------------------------------


def plain_scan(text):
    """Contract's columns, labels and score by plain loops."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    norm, hits = f" {' '.join(words)} ", []
    for number, rule in enumerate(RULES):
        for m in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", norm, re.ASCII):
            start = norm[: m.start()].count(" ") - 1
            hits.append((start, start + m.group().count(" "), rule.priority, number, rule))
    kept = [h for h in hits if not any(g[0] <= h[0] and g[1] >= h[1] and g[2] >= h[2] and (g[:2] != h[:2] or (-g[2], g[3]) < (-h[2], h[3])) for g in hits)]
    base = [h for h in hits if h[4].base]
    starts, names = [h[0] for h in base], sorted({h[4].label for h in base})
    labels = sorted({*names, *(h[4].label for h in kept)})
    top = max((h[2] for h in kept), default=0)
    return len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(names), ",".join(labels), {0: 0.0, **license_scan.WEIGHTS}[top]


LICENSE_TEXTS = [
    None, "", " \n", "...!?", "no such thing here", "MIT License", "the mit-license, MIT\nLICENSE", "summit license", "émit license", "mit licenseé mit\x00license",
    "Licensed under the Apache License, Version 2.0 (the \"License\")", "under the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GNU Lesser General Public License v2.1 and the GNU Affero General Public License", "SPDX-License-Identifier: MIT OR Apache-2.0", "SPDX-License-Identifier: Foo\n(c) Copyright 2019-2024 Some Inc. All rights reserved.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit license " * 4000, "word " * 20_000 + "Boost Software License 1.0",
    "Redistribution and use in source and binary forms, with or without modification, are permitted", "Released into the PUBLIC DOMAIN under CC0 1.0 Universal", "general public license mit license apache license", "MIT License",
]


def test_license_scan(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in license_scan.license_scan(docs_of(spark, LICENSE_TEXTS)).collect()}
    assert got == {i: plain_scan(t) for i, t in enumerate(LICENSE_TEXTS)}


def test_license_spans(spark):
    rows = license_scan.license_spans(docs_of(spark, LICENSE_TEXTS[:16])).collect()
    assert {r["label"] for r in rows if r["doc_id"] == 11 and r["kept"]} == {"gpl-2.0-or-later"}
    assert any(not r["kept"] and r["label"] == "gpl" for r in rows if r["doc_id"] == 11)


def test_license_scan_of_no_rows(spark):
    assert license_scan.license_scan(docs_of(spark, ["a"]).limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "mit license"), (1, "mit license"), (None, "x")], "doc_id bigint, text string")
    assert sorted((r["doc_id"] or 0, r["n_base"]) for r in license_scan.license_scan(twice).collect()) == [(0, 0), (1, 1), (1, 1)]


@given(st.sampled_from(RULES), st.data())
@settings(max_examples=300, deadline=None)
def test_what_a_rule_matches_holds_its_stem_and_keyword(rule, data):
    text = data.draw(st.from_regex(re.compile(rule.pattern, re.ASCII), fullmatch=True))
    assert rule.stem in text and rule.keyword in text


# ---- against SQL -----------------------------------------------------------------------------------


@pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", ["op12_conversation_repair", "op13_license_scan"])
def test_query(spark, name):
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    want = sorted(cursor.fetchall(), key=repr)
    assert sorted((tuple(r) for r in QUERIES[name](spark, str(DATA)).select(*columns).collect()), key=repr) == want

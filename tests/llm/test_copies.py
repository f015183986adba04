"""Exact, near and line duplicates, archives and fingerprints against brute force on small tables."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from circlet.llm import exact_dedup, fingerprint, line_dedup, near_dedup, warc
from circlet.llm.components import components
from circlet.llm.shingles import circulant_signature, shingle_set

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = ("slot0", "candidate", "row", "kept", "key", "bucket", "score", "payload", "sha")


def clash(frame):
    """Extra columns with names that operators use inside."""
    return frame.withColumns({name: F.lit(i) for i, name in enumerate(CLASH)})


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(i + first, t, "en", "s", None) for i, t in enumerate(texts)], SCHEMA)


def words(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd():
    """Null, empty, blank, very long, equal and nearly equal texts."""
    rng = random.Random(4)
    base = words(rng, 120)
    near = [" ".join([*base.split()[:60], f"new{i}", *base.split()[61:]]) for i in range(6)]
    return [None, "", " \n\t", "one two", "one two", "A b c d e f", "a B c d e f", words(rng, 30_000), base, base, *near, words(rng, 90), "\n".join(["a common line here"] * 3), "a Common line here \nown line number two"]


# ---- exact ----------------------------------------------------------------------------------


def test_exact_groups(spark, odd):
    docs = docs_of(spark, odd)
    got = {r["doc_id"]: r for r in exact_dedup.exact_groups(docs, bits=2**17).collect()}
    for i, t in enumerate(odd):
        same = [j for j, u in enumerate(odd) if (u or "") == (t or "")]
        assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (max(same), len(same), i == max(same))
        assert got[i]["text_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_exact_filter_that_is_too_small_changes_nothing(spark):
    rng = random.Random(5)
    texts = [f"text {rng.randrange(9000)}" for _ in range(12_000)]
    docs = docs_of(spark, texts)
    small, large = (exact_dedup.exact_groups(docs, bits=b).drop("candidate").orderBy("doc_id").collect() for b in (2**16, 2**20))
    assert small == large
    assert exact_dedup.exact_groups(docs, bits=2**20).where("not candidate").count() > 1000  # most unique rows pass straight


def test_exact_rows(spark, odd):
    docs = clash(docs_of(spark, odd).union(docs_of(spark, odd[3:4], 3)))  # one row repeated
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({u or "": j for j, u in enumerate(odd)}.values())
    no_id = spark.createDataFrame([(None, "x"), (None, "x"), (7, "x")], "doc_id bigint, text string")
    assert [r["doc_id"] for r in exact_dedup.drop_exact_copies(no_id).collect()] == [7]
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0 == exact_dedup.drop_exact_copies(docs.limit(0)).count()


# ---- near -----------------------------------------------------------------------------------


def brute_near(texts, similar=85):
    def tokens(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = [tokens(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= similar * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def near_rows(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in frame.collect()}


def test_near_groups(spark, odd):
    assert near_rows(near_dedup.near_groups(clash(docs_of(spark, odd)))) == dict(enumerate(brute_near(odd)))


def test_near_family_without_its_origin(spark):
    """Copies with one to four changed words, the origin missing: chains, leaders and the block search must agree with brute force."""
    rng = random.Random(8)
    texts = []
    for family in range(3):
        base = words(rng, 150, 100_000).split()
        for _ in range(60):
            copy = list(base)
            for place in rng.sample(range(150), rng.choice((1, 2, 2, 3, 4))):
                copy[place] = f"x{rng.randrange(10**9)}"
            texts.append(" ".join(copy))
    texts += texts[:5]
    rng.shuffle(texts)
    assert near_rows(near_dedup.near_groups(docs_of(spark, texts))) == dict(enumerate(brute_near(texts)))


def test_near_rows(spark, odd):
    docs = clash(docs_of(spark, odd).unionByName(docs_of(spark, ["no id"]).withColumn("doc_id", F.lit(None).cast("bigint"))))
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [i for i, (_, c) in enumerate(brute_near(odd)) if c == i]
    assert kept.where("doc_id is null").count() == 1
    assert near_dedup.near_groups(docs.limit(0)).count() == 0


def test_near_stage_of_the_pipeline(spark):
    """Two to eight changed words in texts of 95 to 180: the stage links from 0.8 on, op3 from 0.85, both as brute force does."""
    import corpus_pipeline as P

    rng = random.Random(11)
    texts = []
    for size, changes in ((95, (2,)), (140, (3,)), (150, (1, 2, 3, 4)), (180, (2, 4, 8))):
        for family in range(6):
            base = words(rng, size, 100_000).split()
            for _ in range(2 if len(changes) == 1 else 8):
                copy = list(base)
                for place in rng.sample(range(size), rng.choice(changes)):
                    copy[place] = f"x{rng.randrange(10**9)}"
                texts.append(" ".join(copy))
            texts.append(" ".join(base))
    rng.shuffle(texts)
    docs = docs_of(spark, texts)
    wide, narrow = brute_near(texts, 80), brute_near(texts)
    kept = {r["doc_id"] for r in P.drop_near(spark, docs, None).collect()}
    assert kept == {i for i, (_, c) in enumerate(wide) if c == i}
    assert len(kept) + 10 < sum(c == i for i, (_, c) in enumerate(narrow))  # enough families hold together only from 0.8 on
    assert near_rows(near_dedup.near_groups(docs, similar=80)) == dict(enumerate(wide))
    assert near_rows(near_dedup.near_groups(docs)) == dict(enumerate(narrow))


def test_signature_agrees_with_similarity():
    rng = random.Random(1)
    a = words(rng, 400, 10**6).split()
    b = a[:300] + words(rng, 100, 10**6).split()
    x, y = shingle_set(" ".join(a)), shingle_set(" ".join(b))
    true = len(set(x.tolist()) & set(y.tolist())) / len(set(x.tolist()) | set(y.tolist()))
    same = (circulant_signature(x, 1024) == circulant_signature(y, 1024)).mean()
    assert abs(same - true) < 0.06


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 103), (103, 102)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 103: 100, 102: 100}


# ---- lines ----------------------------------------------------------------------------------


def brute_lines(texts, least=10):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    first = {}
    for i, t in enumerate(texts):
        for line in (t or "").split("\n"):
            first.setdefault(key(line), i)
    out = []
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(key(x)) < least or first[key(x)] == i]
        out.append((len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_lines(spark, odd, partitions):
    rng = random.Random(2)
    texts = odd + ["\n".join(rng.choice(("the very same line", f"a line of number {rng.randrange(50)}", "short", "  The Very Same LINE\t")) for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    docs = clash(docs_of(spark, texts))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        kept = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs))
        got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in kept.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == dict(enumerate(brute_lines(texts)))


def test_line_stream_in_small_batches():
    """Runs that go over batches and open ones at the start of a partition."""
    import pandas as pd

    frame = pd.DataFrame({"h1": [1, 1, 1, 2, 2, 3, 3, 3], "h2": 0, "doc_id": [5, 5, 6, 1, 2, 4, 4, 9], "pos": range(8)})
    for size in (1, 2, 3, 8):
        out = pd.concat(line_dedup._stream(iter([frame[i : i + size] for i in range(0, 8, size)])))
        assert out[out.state == line_dedup.DROPPED]["pos"].tolist() == [2, 4, 7]
        assert out[out.state == line_dedup.OPEN]["pos"].tolist() == [0, 1]
        assert out[out.state == line_dedup.TAIL][["h1", "doc_id"]].values.tolist() == [[3, 4]]


def test_lines_without_rows_or_ids(spark):
    empty = docs_of(spark, ["x"]).limit(0)
    assert line_dedup.line_bitmaps(empty).count() == 0
    docs = spark.createDataFrame([(None, "a line of some length"), (1, "a line of some length")], "doc_id bigint, text string")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs)).collect()
    assert [r["kept_text"] for r in kept] == ["a line of some length"] * 2


def test_bitmaps():
    keep = line_dedup.unpack_bits(line_dedup.pack_bits(19, [0, 8, 18]), 19)
    assert [i for i, k in enumerate(keep) if not k] == [0, 8, 18]


# ---- archives -------------------------------------------------------------------------------


def test_archives_round_trip(spark):
    long, other = "é" * 600, "<p>" + "x" * 2000
    html = [None, "", "short", "short", long, long, other, "a\r\n\r\nWARC/1.0\r\n\r\n" * 100, "y" * 3_000_000, long]
    rows = [(i, None if i == 3 else f"http://e.org/a b/{i}", h) for i, h in enumerate(html)]
    pages = clash(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    got = {r["page_id"]: r for r in warc.read_archives(warc.convert(pages)).collect()}
    assert len(got) == len(html)
    for i, h in enumerate(html):
        body = (h or "").encode()
        same = [j for j, g in enumerate(html) if (g or "") == (h or "")]
        target = max(same) if len(body) >= 1000 and i != max(same) else None
        assert (got[i]["payload_bytes"], got[i]["payload_digest"], got[i]["refers_to"]) == (len(body), hashlib.sha1(body).hexdigest(), target)
        assert got[i]["record_type"] == ("response" if target is None else "revisit")
        assert got[i]["payload"] == (body if target is None else None)
    assert got[3]["url"] == "about:blank" and got[4]["url"] == "http://e.org/a%20b/4"
    assert warc.read_archives(warc.convert(pages.limit(0))).count() == 0


def test_archives_of_an_id_with_two_payloads(spark):
    """Only the payload that a larger page repeats is a revisit; the other one of the same id stays whole."""
    shared, alone = "s" * 2000, "u" * 2000
    pages = spark.createDataFrame([(1, "http://e.org/1", shared), (1, "http://e.org/1", alone), (2, "http://e.org/2", shared)], "page_id bigint, url string, html string")
    got = [(r["page_id"], r["record_type"], r["refers_to"], r["payload"] and bytes(r["payload"]).decode()) for r in warc.read_archives(warc.convert(pages)).collect()]
    assert sorted(got, key=str) == sorted([(1, "revisit", 2, None), (1, "response", None, alone), (2, "response", None, shared)], key=str)


@pytest.mark.parametrize("version", [1, 2])
def test_arc_records(version):
    import io

    data = warc.arc_start(version, "x.arc", "20010203040506") + warc.arc_record(version, "http://a/", "1.2.3.4", "20010203040506", "text/html", b"one\n\ntwo") + warc.arc_record(version, "http://b/", "-", "20010203040507", "text/html", b"")
    assert [(f["url"], f["date"], b) for f, b in warc.parse_arc(io.BytesIO(data))] == [("http://a/", "20010203040506", b"one\n\ntwo"), ("http://b/", "20010203040507", b"")]
    with pytest.raises(ValueError):
        list(warc.parse_arc(io.BytesIO(data[:-6])))


# ---- fingerprints ---------------------------------------------------------------------------


def test_fingerprints(spark, odd):
    rng = random.Random(6)
    texts = odd + [words(rng, 200, 3000) for _ in range(40)]
    ids = [i * 97 for i in range(len(texts))]  # over several buckets of ids
    docs = clash(spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string"))
    got = {r["doc_id"]: r for r in fingerprint.edit_report(docs).collect()}
    assert sorted(got) == ids
    by_text = {}
    for k, i in enumerate(ids):
        text, after = texts[k] or "", texts[k - 1] or ""  # the next smaller id; before the first comes the last
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert by_text.setdefault(edited, r["edited_fingerprint"]) == r["edited_fingerprint"]
        if edited == text:
            assert r["near_edited"] == 1.0
    fresh = [got[i] for i in ids[-40:]]
    assert 0.4 < sum(r["near_edited"] for r in fresh) / 40 < 0.62  # two thirds stay: 0.5 and what the texts share anyway
    assert sum(r["near_next"] for r in fresh) / 40 < 0.15
    assert fingerprint.edit_report(docs.limit(0)).count() == 0


def test_samples_collide_like_weighted_sets(spark):
    """The share of equal samples is the generalised Jaccard similarity."""
    a = " ".join(["alphabet"] * 6 + ["building"] * 2 + [f"onlyleft{i}" for i in range(4)])
    b = " ".join(["alphabet"] * 3 + ["building"] * 5 + [f"onlyright{i}" for i in range(2)])
    rows = spark.createDataFrame([(0, a), (1, b)], "k int, t string")
    x, y = (r["fingerprint"] for r in fingerprint.fingerprints(rows, ["k"], "t", samples=400).orderBy("k").collect())
    true = (3 + 2) / (6 + 5 + 4 + 2)
    assert abs(sum(p == q for p, q in zip(x, y)) / 400 - true) < 0.08


def test_pairs_of_a_leader_over_salts(spark, monkeypatch):
    """A leader with more pairs than stay together gives the same groups."""
    rng = random.Random(11)
    base = words(rng, 100).split()
    texts = [" ".join([*base[:50], f"new{i}", *base[51:]]) for i in range(60)] + [words(rng, 80) for _ in range(20)]
    docs = docs_of(spark, texts)
    monkeypatch.setattr(near_dedup, "LEADER_PAIRS", 7)
    got = sorted((r["doc_id"], r["component_id"]) for r in near_dedup.near_groups(docs).collect())
    assert got == [(i, 0) if i < 60 else (i, i) for i in range(80)]


def test_dropping_a_very_common_text(spark):
    texts = ["same"] * 3000 + ["other", "other", "one"]
    kept = exact_dedup.drop_exact_copies(docs_of(spark, texts), bits=2**17).collect()
    assert sorted(r["doc_id"] for r in kept) == [2999, 3001, 3002]

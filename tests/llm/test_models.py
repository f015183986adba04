"""Classifiers, pieces, packing and the pipeline on small tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from circlet.llm import language, packing, pieces, quality, toxicity
from circlet.llm.queries import vocabulary
from circlet.llm.tokens import ByteTokenizer

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = ("label", "features", "vector", "raw", "score", "calibrated", "c0", "row", "pack_salt", "offset", "ids")


def clash(frame):
    return frame.withColumns({name: F.lit(i) for i, name in enumerate(CLASH)})


def prose(rng, n, syllables):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(n))


ENGLISH, GERMAN = ["the", "ing", "er", "on", "th", "ea", "st"], ["sch", "ung", "ä", "ich", "ö", "tz", "keit"]


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents with languages, labels, and the odd cases at the end."""
    rng, rows, labels = random.Random(3), [], []
    for i in range(400):
        lang = ("en", "de")[i % 2]
        text = prose(rng, 150, ENGLISH if i % 2 == 0 else GERMAN)
        toxic, bad = i % 5 == 0, i % 7 == 0
        if toxic:
            parts = text.split()
            for _ in range(3):
                parts.insert(rng.randrange(len(parts)), "idiot" if lang == "en" else "vequ" + rng.choice(GERMAN))
            text = " ".join(parts)
        if bad:
            half = len(text) // 2
            text = text[:half] + " " + " ".join(w.upper() + "###" for w in text[half:].split())
        rows.append((i, text, lang, "s", None))
        labels.append((i, int(not bad), int(toxic)))
    rows += [(400, None, "en", "s", 0), (401, "", None, "s", 0), (402, " 12 !?", "de", "s", 0), (403, prose(rng, 20_000, ENGLISH), None, "s", 0), (404, "Ärger", "de", "s", 0), (404, "Ärger", "de", "s", 0)]
    labels += [(400, 1, 0), (404, 1, 0), (404, 0, 1), (9999, 1, 1), (None, 1, 1), (5, None, None)]
    return clash(spark.createDataFrame(rows, SCHEMA)), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def accuracy(got, truth):
    return np.mean([got[i] == t for i, t in truth.items()])


def check_scores(frame, docs, mod, hold, truth):
    rows = frame.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % mod == hold)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    return accuracy({r["doc_id"]: r["predicted"] for r in rows if r["held_out"]}, {i: t for i, t in truth.items() if zlib.crc32(str(i).encode()) % mod == hold})


def test_toxicity(corpus):
    docs, labels = corpus
    assert check_scores(toxicity.toxicity(docs, labels), docs, 5, 0, {i: int(i % 5 == 0) for i in range(400)}) > 0.95


def test_toxicity_features():
    f = dict(zip(toxicity.FEATURES, toxicity.features("You IDIOT, you 1d10t! i d i o t looooser", {})))
    assert f["seed_hits"] > 0 and f["near_second_person"] > 0 and f["obfuscated_hits"] > 0 and f["capitals"] > 0 and f["exclamations"] > 0 and f["stretched"] > 0
    assert set(toxicity.features("", {})) == {0.0}


def test_quality(corpus):
    docs, labels = corpus
    assert check_scores(quality.quality(docs, labels), docs, 3, 1, {i: int(i % 7 != 0) for i in range(400)}) > 0.95


def test_quality_gradient():
    """The hand-written gradient moves every weight down the loss."""
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(rng.integers(1, 5), quality.INPUTS)) + 3 * (i % 2) * (rng.random() < 2) for i in range(60)]
    labels = np.array([i % 2 for i in range(60)], float)
    model = quality.learn(bags, labels)
    starts = np.cumsum([0, *map(len, bags)])[:-1]
    assert ((model.forward(np.concatenate(bags), starts)["p"] > 0.5) == labels).all()
    assert np.allclose(np.add.reduceat(model.forward(np.concatenate(bags), starts)["a"], starts), 1)


@pytest.mark.parametrize("run", [toxicity.toxicity, quality.quality])
def test_classifiers_without_labels(corpus, run):
    docs, labels = corpus
    assert {r["score"] for r in run(docs.limit(5), labels.limit(0)).collect()} == {0.0}
    assert {r["score"] for r in run(docs, labels.withColumns({"toxic": F.lit(1), "quality": F.lit(1)})).collect()} == {1.0}
    assert run(docs.limit(0), labels).count() == 0


def test_language(corpus):
    docs, _ = corpus
    got = {r["doc_id"]: r for r in language.identify(docs).collect()}
    assert language.identify(docs).count() == docs.count()
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert accuracy({i: got[i]["lang_pred"] for i in held}, {i: ("en", "de")[i % 2] for i in held}) > 0.98
    assert [got[i]["lang_pred"] for i in (400, 401, 402)] == ["und"] * 3 and got[403]["lang_pred"] == "en" and got[404]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert {r["lang_pred"] for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.identify(docs.limit(0)).count() == 0


def test_rejection(corpus):
    docs, _ = corpus
    model = language.fit(docs.where(~language.held_out()))
    assert model.predict("日本語の文章です。" * 20)[2] and not model.predict(prose(random.Random(9), 150, ENGLISH))[2]


# ---- pieces ---------------------------------------------------------------------------------


def every_path(text, known, least):
    """All segmentations with their scores, best first."""
    full, out = pieces.BLANK + text.replace(" ", pieces.BLANK), []

    def go(at, score, ids):
        if at == len(full):
            out.append((score, ids))
            return
        for k in range(1, 6):
            if full[at : at + k] in known and at + k <= len(full):
                i, s = known[full[at : at + k]]
                go(at + k, score + s, [*ids, i])
        if full[at] not in known:
            go(at + 1, score + least, ids + list(full[at].encode()))

    go(0, 0.0, [])
    return sorted(out, key=lambda x: -x[0])


@pytest.mark.parametrize("seed", range(4))
def test_n_best_paths(seed):
    rng = random.Random(seed)
    names = sorted({pieces.BLANK + x for x in ("a", "ab", "b", "abc")} | {pieces.BLANK, pieces.BLANK * 2, "a", "b", "ab", "ba", "aab", "bb", "c"})
    listed = [(p, i + 300, -float(rng.randint(1, 40))) for i, p in enumerate(names)]
    lattice = pieces.PieceLattice(listed, list(range(256)), 4)
    for _ in range(40):
        text = "".join(rng.choice("abc  dé") for _ in range(rng.randint(1, 9)))
        ((ids, scores, _),) = lattice.encode([text])
        paths = every_path(text, lattice.known, lattice.least)
        assert scores == pytest.approx([s for s, _ in paths[:4]])
        assert np.frombuffer(ids, "<i4").tolist() in [i for s, i in paths if s == paths[0][0]]
        assert lattice.decode(ids) == text


def test_pieces_round_trip(corpus):
    docs, _ = corpus
    rows = pieces.encode_documents(docs, vocabulary("piece_bpe_32k.model")).collect()
    import hashlib

    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
        assert r["scores"] == sorted(r["scores"], reverse=True) and r["n_ids"] * 4 == len(r["ids"]) and zlib.crc32(r["ids"]) == r["ids_crc32"]
    lattice = pieces.PieceLattice.load(vocabulary("piece_bpe_32k.model"))
    for text in ("", "  a  b ", "x▁y", "日本\n\tz", "a" * 3000):
        ((ids, _, _),) = lattice.encode([text])
        assert lattice.decode(ids) == text
    assert pieces.encode_documents(docs.limit(0), vocabulary("piece_bpe_32k.model")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_ids_of_all_paths(seed):
    rng = random.Random(seed)
    names = sorted({pieces.BLANK + x for x in ("a", "ab", "b", "abc")} | {pieces.BLANK, pieces.BLANK * 2, "a", "b", "ab", "ba", "aab", "bb", "c"})
    listed = [(p, i + 300, -float(rng.randint(1, 40))) for i, p in enumerate(names)]
    lattice = pieces.PieceLattice(listed, list(range(256)), 4)
    for _ in range(40):
        text = "".join(rng.choice("abc  dé") for _ in range(rng.randint(0, 9)))
        ((ids, scores, paths),) = lattice.encode([text])
        known = {tuple(i): s for s, i in every_path(text, lattice.known, lattice.least)} if text else {(): 0.0}
        found = [tuple(np.frombuffer(p, "<i4").tolist()) for p in paths]
        assert paths[0] == ids and len(set(found)) == len(found) == len(scores) == min(4, len(known))
        assert [known[p] for p in found] == pytest.approx(scores)
        assert all(lattice.decode(p) == text for p in paths)


def test_paths_of_documents(corpus):
    docs, _ = corpus
    model = vocabulary("piece_bpe_32k.model")
    lattice, texts = pieces.PieceLattice.load(model), {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = pieces.encode_documents(docs, model).collect()
    for r in rows:
        assert [p["score"] for p in r["paths"]] == r["scores"] and r["paths"][0]["ids"] == r["ids"]
        assert len({bytes(p["ids"]) for p in r["paths"]}) == len(r["paths"])
        for p in r["paths"]:
            assert p["same_text"] and lattice.decode(bytes(p["ids"])) == texts[r["doc_id"]]
            assert p["n_ids"] * 4 == len(p["ids"]) and p["ids_crc32"] == zlib.crc32(p["ids"])
    assert sum(len(r["paths"]) == 4 for r in rows) >= 400
    short = pieces.encode_documents(docs, model, with_ids=False).collect()
    assert sorted((str(r["doc_id"]), [tuple(p) for p in r["paths"]]) for r in short) == sorted((str(r["doc_id"]), [tuple(p)[:4] for p in r["paths"]]) for r in rows)


# ---- packing --------------------------------------------------------------------------------


def test_tokens_equal_the_library():
    tokenizer = ByteTokenizer.load(vocabulary("byte_bpe_50k.json"))
    assert tokenizer.fast is not None
    for text in ("", "  a b  c ", "don't  we'll\t\tx\n", "é ñ 日本 語 🙂", "a <|endoftext|> b", "12345 !!?? .." * 50):
        assert np.frombuffer(tokenizer.encode(text), "<u4").tolist() == tokenizer.tokenizer.encode(text, add_special_tokens=False).ids


def test_plan():
    rng = random.Random(2)
    for _ in range(30):
        counts = {rng.randint(1, 64): rng.randint(1, 50) for _ in range(rng.randint(1, 20))}
        plan = packing.best_plan(counts, 64)
        used = {}
        for lengths, times in plan:
            assert sum(lengths) <= 64
            for x in lengths:
                used[x] = used.get(x, 0) + times
        assert used == counts
        bins, least = sum(n for _, n in plan), -(-sum(k * v for k, v in counts.items()) // 64)
        assert bins <= max(least * 1.3 + 2, sum(v for k, v in counts.items() if k > 32))
    assert packing.plan_bins({6: 1, 4: 1, 3: 2, 2: 0}, 10) == [([6, 4], 1), ([3, 3], 1)]
    assert packing.plan_bins({6: 1, 3: 1, 2: 2}, 10) == [([6, 2, 2], 1), ([3], 1)]  # 3 gave way to two that fit more tightly


def brute_pieces(texts, tokenizer):
    out = {}
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        for n, start in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[start : first if start == 0 else start + 1024]
            out[doc_id, n] = (start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    return out


def check_packing(rows, texts):
    from tokenizers import Tokenizer

    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == brute_pieces(texts, Tokenizer.from_file(vocabulary("byte_bpe_50k.json")))
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in places.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= 1024
    return len(places)


def test_packing(corpus):
    docs = corpus[0].dropDuplicates(["doc_id"])
    placed = packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))
    rows = placed.collect()
    bins = check_packing(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    decreasing = []
    for length in sorted((r["length"] for r in rows), reverse=True):
        at = next((i for i, gap in enumerate(decreasing) if gap >= length), None)
        decreasing.append(1024 - length) if at is None else decreasing.__setitem__(at, decreasing[at] - length)
    assert bins <= len(decreasing)  # never worse than first fit by falling length
    whole = packing.packed_sequences(docs, placed, vocabulary("byte_bpe_50k.json")).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * sum(r["length"] for r in rows)
    assert packing.pack_documents(docs.limit(0), vocabulary("byte_bpe_50k.json")).count() == 0


# ---- pipeline -------------------------------------------------------------------------------


def test_pipeline_against_its_parts(spark, corpus, tmp_path):
    import corpus_pipeline as P

    docs, labels = corpus
    base = docs.dropDuplicates(["doc_id"])
    copies = base.where("doc_id between 1 and 30").withColumn("doc_id", F.col("doc_id") + 1000)
    near = base.where("doc_id between 31 and 60").withColumns({"doc_id": F.col("doc_id") + 2000, "text": F.concat("text", F.lit(" the end"))})
    full = base.unionByName(copies).unionByName(near)
    full.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs, texts = spark.read.parquet(str(tmp_path / "documents.parquet")), None
    for name, stage in P.STAGES:
        after = stage(spark, docs, str(tmp_path))
        if name == "packing":
            check_packing(after.collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])
            continue
        assert after.columns == docs.columns
        after.write.parquet(str(tmp_path / name))
        before, kept = {r["doc_id"]: r["text"] for r in docs.collect()}, {r["doc_id"] for r in spark.read.parquet(str(tmp_path / name)).collect()}
        if name == "toxicity":
            own = {r["doc_id"] for r in toxicity.toxicity(docs, labels).where("predicted = 0").collect()}
            assert kept == own and sum(i % 5 == 0 for i in before if i < 400) > 70 and sum(i % 5 == 0 for i in kept if i < 400) < 5
        elif name == "quality":
            assert sum(i % 7 == 0 for i in kept if i < 400) < 5 and sum(i % 7 != 0 for i in kept if i < 400) > 0.95 * sum(i % 7 != 0 for i in before if i < 400)
        elif name == "exact_dedup":
            assert kept == {max(j for j, u in before.items() if (u or "") == (t or "")) for t in before.values()}
        else:
            assert not any(i in kept for i in range(2031, 2061) if i - 2000 in before)
        docs = spark.read.parquet(str(tmp_path / name))


def test_pipeline_empty(spark, corpus, tmp_path):
    import corpus_pipeline as P

    docs, labels = corpus
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    labels.limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0

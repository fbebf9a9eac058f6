"""Document operators against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from snaplytics.llm import bpe, exact_dedup, graph, line_dedup, lm, mixing, quality, simhash
from snaplytics.llm.common import staged

from .tables import CLASH, DOCS, documents, document_rows, prose, rows_of

GAPS = " \t\n\x0b\x0c\r"


def words_of(text):
    return (text or "").encode().split()


def kept_columns(docs, out):
    assert out.columns == docs.columns
    return out


# ---- mixing


def test_mix_takes_near_target_and_reruns_agree(spark):
    docs = documents(spark, extra=True)
    report = mixing.mix_report(docs).collect()
    assert len(report) == docs.count()
    by_source = {}
    for r in report:
        assert r.taken in (0, r.size, 2 * r.size)
        if r.doc_id in UNIQUE:
            assert r.size == len(words_of(TEXT[r.doc_id]))
        s = by_source.setdefault(r.source, [0, r.target, r.source_size, 0])
        s[0] += r.taken
        s[3] = max(s[3], r.size)
    for taken, target, size, largest in by_source.values():
        assert abs(taken - target) <= largest and target <= 2 * size
    total = sum(s[2] for s in by_source.values())
    assert sum(s[1] for s in by_source.values()) == pytest.approx(1.5 * total)
    assert sorted(map(repr, report)) == sorted(map(repr, mixing.mix_report(docs.repartition(5)).collect()))


UNIQUE = {k for k, n in Counter(r[0] for r in document_rows()).items() if n == 1 and k is not None}
TEXT = {r[0]: r[1] for r in document_rows()}


def test_mix_repeats_rows_and_keeps_columns(spark):
    docs = documents(spark, extra=True)
    times = {}
    for r in mixing.mix_report(docs).collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + r.times
    got = Counter(r.doc_id for r in kept_columns(docs, mixing.mix_sources(docs)).collect())
    assert got == Counter({k: v for k, v in times.items() if v})


def test_targets_reshare_excess(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 0)], "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # a (weight 5) stops at 20; b and c share the other 2995 as 2 : 1
    assert got == pytest.approx({"a": 20.0, "b": 2995 * 2 / 3, "c": 2995 / 3, None: 0.0})
    capped = mixing.source_targets(spark.createDataFrame([("a", 100), ("b", 100)], "source string, source_size bigint"))
    assert {r.source: r.target for r in capped.collect()} == {"a": 200.0, "b": 100.0}


# ---- language model


def test_lm_base_figures_and_rows(spark):
    docs = documents(spark, extra=True)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = lm.lm_scores(docs, held, rounds=1).collect()
    rows = document_rows()
    out = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    tokens = [[*(w.lower() for w in words_of(r[1])), b""] for r in rows]
    c = Counter(t for ts, o in zip(tokens, out) if not o for t in ts)
    n, v = sum(c.values()), len(c)
    want = sorted((repr(r[0]), o, len(ts), sum(c[t] > 0 for t in ts), n, round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts), 5))
                  for r, ts, o in zip(rows, tokens, out))
    assert want == sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got)
    assert all(r.score < 0 for r in got)


def test_lm_is_a_distribution_and_learns(spark):
    """Classes and members each sum to one, and training raises the held-out score."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"a{k} b{k}" for k in rng.integers(8, size=60)), "en", "s") for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    held = F.col("doc_id") % 5 == 0
    scores = [lm.lm_scores(docs, held, rounds=k).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first() for k in (0, 3)]
    assert scores[1][0] > scores[0][0] and scores[1][0] > scores[1][1] + 100
    model = lm.Model({"": 0}, np.ones(lm.BUCKETS), np.ones(lm.BUCKETS))
    model.weights += rng.normal(size=model.weights.shape).astype(np.float32)
    rows_, cls = [rng.integers(lm.ROWS, size=9) for _ in range(lm.FEATURES)], rng.integers(lm.CLASSES, size=9)
    for layer in (0, 1):
        e, sums = model.layer(layer, rows_, cls)
        assert e.shape == (9, lm.MEMBERS) and (e / sums[:, None]).sum(axis=1) == pytest.approx(np.ones(9), abs=1e-4)
        z = sum(model.weights[layer, k][rows_[k]] for k in range(lm.FEATURES)) + (model.member_bias[cls] if layer else model.class_bias)
        assert e == pytest.approx(np.exp(z), rel=1e-3)


def test_lm_buckets_agree_in_both_engines(spark):
    some = ["a", "abc", "straße", "漢字漢字", "x" * 50, ""]
    df = spark.createDataFrame([(w,) for w in some], "word string")
    got = [r.b for r in df.select(lm.bucket_column(F.col("word"), F.lit(None).cast("int")).alias("b")).collect()]
    assert got == [lm.shared_bucket(w) for w in some]


def test_lm_histories_have_4096_rows_of_each_feature(spark):
    """Of 30,000 different histories, nearly every one of 4,096 rows is met, and the observed counts are whole."""
    rows = [(i, " ".join(f"w{i * 1000 + j}" for j in range(1000)), "en", "s") for i in range(30)]
    docs = spark.createDataFrame(rows, DOCS)
    chunks = lm.chunked(docs.select("doc_id", "text", F.lit(False).alias("held_out")))
    model = lm.Model({"": 0}, np.ones(lm.BUCKETS), np.ones(lm.BUCKETS))
    sums = lm.gradient_sums(chunks, spark.sparkContext.broadcast(model), True).toArrow()
    found = Counter((sums.column("model_row").to_numpy() // lm.ROWS).tolist())
    assert set(found) == set(range(2 * lm.FEATURES)) and min(found.values()) > 4000
    assert sum(sums.column(c).to_numpy().sum() for c in lm.OBSERVED) == 2 * lm.FEATURES * 30 * 1001


# ---- SimHash


def fingerprint_plain(text):
    import xxhash
    ws = words_of(text)
    ws = [w.lower() for w in ws]
    if not ws:
        return 0
    shingles = [b" ".join(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_plain(fps):
    root = {f: f for f in fps}
    for _ in fps:
        for a in fps:
            for b in fps:
                if bin(a ^ b).count("1") <= 4:
                    root[a] = root[b] = min(root[a], root[b])
    return root


@pytest.mark.parametrize("limit", [128, 1])
def test_simhash_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash.links, "__defaults__", (4, limit))
    rng = np.random.default_rng(3)
    base = int(rng.integers(1 << 62))
    fps = {base, 0, 1, (1 << 64) - 1, *(int(x) for x in rng.integers(1 << 63, size=30))}
    for _ in range(60):
        f = base
        for b in rng.integers(64, size=rng.integers(1, 8)):
            f ^= 1 << int(b)
        fps.add(f)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint")
    roots = {r.node % (1 << 64): r.root for r in graph.components(simhash.links(df)).collect()}
    want = components_plain(fps)
    group = lambda of: sorted(sorted(f for f in fps if of(f) == k) for k in {of(f) for f in fps})
    assert group(lambda f: roots.get(f, f)) == group(want.get)


def linked_groups(spark, fps, **kw):
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint")
    roots = {r.node % (1 << 64): r.root for r in graph.components(simhash.links(df, **kw)).collect()}
    return sorted(sorted(f for f in fps if roots.get(f, f) == k) for k in {roots.get(f, f) for f in fps})


def near_copies(rng, fps):
    for f in rng.choice(np.array(fps, np.uint64), 20, replace=False).tolist():
        for b in rng.choice(64, size=rng.integers(1, 5), replace=False):
            f ^= 1 << int(b)
        yield f


def plain_groups(fps):
    a = np.array(fps, np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= 4
    reach = np.linalg.matrix_power(near.astype(float), 8) > 0  # planted groups are shallow
    return sorted(sorted(fps[j] for j in np.flatnonzero(row)) for i, row in enumerate(reach) if np.flatnonzero(row)[0] == i)


@pytest.mark.parametrize("shared", [0, 11])
def test_simhash_classes_that_meet_by_chance_make_no_patterns(spark, monkeypatch, shared):
    """Equal bit counts (shared = 0: one bit of every two is set) put no classes in one cell, and classes
    that share two blocks of six go on with finer cells; neither makes 2,081 patterns a class."""
    rng = np.random.default_rng(11)
    halves = rng.integers(2, size=(400, 32))
    halves[:, :shared] = halves[0, :shared]
    fps = [sum((1 + int(h)) << (2 * i) for i, h in enumerate(row)) for row in halves]
    fps = sorted({*fps, *near_copies(rng, fps)})
    monkeypatch.setattr(simhash, "flip_patterns", lambda classes: pytest.fail("patterns of chance company"))
    assert linked_groups(spark, fps, cell_limit=64) == plain_groups(fps)


def test_rounds_of_components_broadcast_small_tables_only(spark, monkeypatch):
    """The driver holds the tables of all rounds beside each other."""
    seen = []
    real = graph.broadcast_if_small
    monkeypatch.setattr(graph, "broadcast_if_small", lambda df, most=8 << 20: seen.append(most) or real(df, most))
    edges = [(i, i + 1) for i in range(1, 40)]
    assert graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).count() == 40
    assert len(seen) > 1 and max(seen) <= 1 << 20


def test_simhash_report_and_dedup(spark):
    docs = documents(spark, extra=True)
    got = simhash.simhash_report(docs).collect()
    fps = {r[1]: fingerprint_plain(r[1]) for r in document_rows()}
    root = components_plain(sorted(set(fps.values())))
    least = {}
    for i, text, *_ in document_rows():
        k = root[fps[text]]
        least[k] = min((x for x in (least.get(k), i) if x is not None), default=None)
    want = sorted((repr(i), f"{fps[t]:016x}", repr(least[root[fps[t]]])) for i, t, *_ in document_rows())
    assert want == sorted((repr(r.doc_id), r.fingerprint, repr(r.component_id)) for r in got)
    kept = kept_columns(docs, simhash.dedup(docs)).collect()
    assert len(kept) == len(set(root.values()))
    assert sorted(repr(r.doc_id) for r in kept) == sorted(map(repr, least.values()))


def test_components_of_chain_star_and_none(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(5, 5)]
    got = graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, groups.values())) == [40, 40]
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# ---- byte-level BPE


def test_bpe_equals_tiktoken_and_round_trips(spark):
    docs = documents(spark, extra=True)
    ranks = bpe.read_ranks(bpe.default_vocabulary())
    exact = tiktoken.Encoding("own", pat_str=bpe.default_pattern(), mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, text, *_ in document_rows():
        ids = exact.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    coded = bpe.encode_documents(docs, with_ids=True)
    assert rows_of(coded, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert rows_of(bpe.decode_documents(coded), "doc_id", "text") == sorted(((r[0], r[1] or "") for r in document_rows()), key=repr)


def test_bpe_parts_and_split_characters():
    coder = bpe.load(bpe.default_vocabulary(), bpe.default_pattern())
    for text in ("a  b", " a", "a ", "a\n b", "a \u2003b", "don't 12 ,.!", "\u3000x y", "  ", "a\u00a0 b", "x \x85 y"):
        assert "".join(bpe.independent_parts(text)) == text
        assert b"".join(coder.encode_all([text])) == np.array(coder.encode(text)[0], "<u4").tobytes()
    ids, offsets = coder.encode("a 😀 b")
    assert "".join(coder.decode_stream(ids)) == "a 😀 b"
    assert max(e for _, e in offsets) == 5
    split = [coder.tokenizer.token_to_id(c) for c in (bpe.byte_characters()[b] for b in "é".encode())]
    assert list(coder.decode_stream(split)) == ["", "é", ""]


# ---- line dedup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def lines_plain(rows):
    place = {}
    for i, text, *_ in rows:
        for n, line in enumerate((text or "").split("\n") if text is not None else []):
            if len(line.strip(GAPS)) >= 20:
                place.setdefault(line, []).append((i is None, i or 0, n))

    def linked(a, b):
        u, v = a.encode().split(), b.encode().split()
        by_words = min(len(u), len(v)) >= 10 and abs(len(u) - len(v)) <= 1 and distance(u, v) <= 1
        return by_words or abs(len(a) - len(b)) <= 2 and len(a) < 400 and distance(a, b) <= 2

    return place, {a: {b for b in place if a != b and linked(a, b)} for a in place}


def test_line_report_equals_brute_force(spark):
    alphabet = "abcd"
    rng = np.random.default_rng(11)
    texts = ["".join(rng.choice(list(alphabet), size=24)) for _ in range(8)]
    for t in list(texts):
        for _ in range(6):
            s = list(t)
            for _ in range(int(rng.integers(1, 4))):
                at, how = int(rng.integers(len(s))), int(rng.integers(3))
                s[at:at + (how != 0)] = [] if how == 1 else [str(rng.choice(list("abcdé")))]
            texts.append("".join(s))
    rows = [(i, "\n".join(texts[i::9]), "en", "s") for i in range(9)] + [(20, texts[0], "en", "s"), (21, None, "en", "s"), (22, "", "en", "s")]
    rows += [r for r in document_rows() if r[0] in (83, 85, 88, 89, 90)][:4]
    rows = [r for i, r in enumerate(rows) if r not in rows[:i]]
    got = line_dedup.line_report(spark.createDataFrame(rows, DOCS)).collect()
    place, links = lines_plain(rows)
    want = []
    for line, at in place.items():
        late = any(min(place[o]) < min(at) for o in links[line])
        want += [(p[1], p[2], min(at)[1], min(at)[2], len(links[line]), p == min(at) and not late) for p in at]
    assert sorted(want) == sorted((r.doc_id, r.line_no, r["first"].doc_id, r["first"].line_no, r.n_links, r.kept) for r in got)
    assert sum(len(x) for x in links.values()) > 40


def test_dedup_lines_keeps_rows_and_columns(spark):
    docs = documents(spark, extra=True)
    out = {(r.doc_id, r.source): r.text for r in kept_columns(docs, line_dedup.dedup_lines(docs)).collect()}
    assert len(kept_columns(docs, line_dedup.dedup_lines(docs)).collect()) == docs.count()
    assert out[89, "s1"] == TEXT[89]
    assert out[90, "s1"] == "line 2 is long enough to count\nshort"
    assert out[80, "s2"] is None and out[81, None] == "" and out[83, "s9"] == "one"
    assert out[71, "s1"] == "" and out[70, "s1"] == TEXT[70]
    assert out[84, "s3"] == TEXT[84].split("\n")[0] + "\n"


def test_short_lines_are_deduplicated_when_equal(spark, tmp_path):
    rows = [(1, "Of.\n漢字漢字\n \nOf.", "en", "s"), (2, "Of.\nOf,\n漢字漢字", "en", "s"), (3, "\n \n", "en", "s")]
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    report = line_dedup.op7_line_dedup(spark, str(tmp_path))
    assert rows_of(report, "doc_id", "line_no", "class_doc_id", "class_line_no", "n_links", "kept") == [
        (1, 0, 1, 0, 0, True), (1, 1, 1, 1, 0, True), (1, 3, 1, 0, 0, False),
        (2, 0, 1, 0, 0, False), (2, 1, 2, 1, 0, True), (2, 2, 1, 1, 0, False)]
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert out == {1: "Of.\n漢字漢字\n ", 2: "Of,", 3: "\n \n"}


def one_word_apart(rng, words):
    """The words with one of them replaced, left out or added."""
    at, how = rng.randrange(len(words)), rng.randrange(3)
    return words[:at] + ([] if how == 0 else ["w" * rng.randint(1, 30) + "q"]) + words[at + (how < 2):]


def test_long_lines_one_word_apart_are_linked(spark):
    rng = random.Random(8)
    lines = [prose(rng, n).split(" ") for n in (9, 10, 11, 12, 25, 60, 150) for _ in range(3)]
    rows = [(i, " ".join(w), "en", "s") for i, w in enumerate(lines)]
    rows += [(100 + i, " ".join(one_word_apart(rng, w)), "en", "s") for i, w in enumerate(lines)]
    rows += [(200 + i, " ".join(one_word_apart(rng, one_word_apart(rng, w))), "en", "s") for i, w in enumerate(lines)]
    rows += [(300 + i, "  ".join(w), "en", "s") for i, w in enumerate(lines)]
    got = line_dedup.line_report(spark.createDataFrame(rows, DOCS)).collect()
    place, links = lines_plain(rows)
    assert {r.doc_id: r.n_links for r in got} == {i: len(links[t]) for i, t, *_ in rows}
    assert sum(r.n_links >= 1 for r in got) > 40


def test_planted_one_word_edits_of_long_lines_are_found(spark):
    rng = random.Random(9)
    lines = [prose(rng, rng.randint(16, 80)).split(" ") for _ in range(150)]
    rows = [(i, " ".join(w), "en", "s") for i, w in enumerate(lines)]
    rows += [(1000 + i, " ".join(one_word_apart(rng, w)), "en", "s") for i, w in enumerate(lines)]
    got = {r.doc_id: r.kept for r in line_dedup.line_report(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(got[i] and not got[1000 + i] for i in range(150))


def test_lines_are_staged_without_a_shuffle_of_their_texts(spark, monkeypatch):
    """Texts of lines are written as they are cut, once for links and report; equal ones meet in their keys only."""
    plans = {}

    def seen(df, name, *rest, **more):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, name, *rest, **more)

    monkeypatch.setattr(line_dedup, "staged", seen)
    rows = [(i, f"{t}\n{t}", "en", "s") for i, t in enumerate(["the same line of some words", "the same line of some words", "the same line of sane words"])]
    got = line_dedup.line_report(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id, r.line_no, r.n_links, r.kept) for r in got) == [(i, n, 1, i == n == 0) for i in range(3) for n in range(2)]
    assert "Exchange" not in plans["line-rows"] and "line-texts" not in plans and "transform(" not in plans["line-rows"]


def test_keys_of_many_lines_are_found_without_their_texts(spark, monkeypatch):
    """Beyond the bound of a broadcast the shared keys meet hashes, not a copy of the text for each key; the links are the same."""
    rng = random.Random(10)
    lines = [prose(rng, n).split(" ") for n in (9, 12, 25) for _ in range(6)]
    rows = [(i, " ".join(w), "en", "s") for i, w in enumerate(lines)]
    rows += [(100 + i, " ".join(one_word_apart(rng, w)), "en", "s") for i, w in enumerate(lines)] + [(200 + i, " ".join(w), "en", "s") for i, w in enumerate(lines)]
    rows += [(300 + i, " ".join(w) + "x", "en", "s") for i, w in enumerate(lines)]
    names = []
    monkeypatch.setattr(line_dedup, "broadcast_if_small", lambda df, *a: df)
    monkeypatch.setattr(line_dedup, "staged", lambda df, name, *a, **k: names.append(name) or staged(df, name, *a, **k))
    got = line_dedup.line_report(spark.createDataFrame(rows, DOCS)).collect()
    place, links = lines_plain(rows)
    assert {r.doc_id: r.n_links for r in got} == {i: len(links[t]) for i, t, *_ in rows}
    assert {"line-marks", "word-marks"} <= set(names) and sum(r.n_links >= 1 for r in got) > 40


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_within_edits_equals_plain_distance(spark, edits):
    rng = random.Random(edits)
    rows = [("".join(rng.choice("ab") for _ in range(rng.randint(0, 9))), "".join(rng.choice("abc") for _ in range(rng.randint(0, 9)))) for _ in range(400)]
    rows += [(a, a[:k] + "z" + a[k + 1:]) for a, _ in rows[:50] for k in range(0, len(a), 3)]
    df = spark.createDataFrame([(list(a), list(b)) for a, b in rows], "a array<string>, b array<string>")
    got = df.select("a", "b", line_dedup.within_edits(F.col("a"), F.col("b"), edits).alias("near")).collect()
    assert all(r.near == (distance(r.a, r.b) <= edits) for r in got) and 20 < sum(r.near for r in got) < len(got)


def test_keys_meet_for_every_pair_within_the_threshold(spark):
    rng = np.random.default_rng(2)
    pairs = []
    for n in range(3, 30):
        for _ in range(12):
            a = list(rng.choice(list("ab"), size=n))
            b = list(a)
            for _ in range(2):
                at, how = int(rng.integers(len(b))) if b else 0, int(rng.integers(3))
                b[at:at + (how != 0)] = [] if how == 1 else ["c"]
            pairs.append(("".join(a), "".join(b)))
    df = spark.createDataFrame([(i, *((a, b) if len(a) <= len(b) else (b, a))) for i, (a, b) in enumerate(pairs)], "h bigint, s string, l string")
    keys = lambda c: line_dedup.with_keys(df.select(F.col(c).alias("line"), F.length(c).alias("size"), "h"), 2)
    met = keys("s").filter("own").select("h", "key").intersect(keys("l").select("h", "key"))
    assert met.select("h").distinct().count() == len(pairs)


def test_keys_of_lines_are_cut_without_counting_code_points(spark):
    """Equal segments have equal keys whatever the width of the code points around them; no segment is cut out of a text."""
    texts = ["a line of plain words and 漢字 at its end 😀", "a line of plain words and 漢字 at its end x", "naïve " * 9]
    df = spark.createDataFrame([(i, t, len(t), t.strip(), len(t.split())) for i, t in enumerate(texts)], "h bigint, line string, size int, flat string, n_words int")
    keyed = line_dedup.with_keys(df, 2)
    rows = keyed.collect()
    own = lambda h: {r.key for r in rows if r.h == h and r.own}
    assert len(rows) == 12 * len(texts) and len(own(0) & own(1)) == 2 and not own(0) & own(2)
    assert "substring(line" not in keyed._jdf.queryExecution().optimizedPlan().toString()
    words = line_dedup.with_keys(df, 1, by_words=True).collect()
    assert len({r.key for r in words if r.h == 0 and r.own} & {r.key for r in words if r.h == 1 and r.own}) == 1


def test_offsets_equal_those_of_whole_texts(spark):
    texts = [r[1] for r in document_rows()[:20]] + [None, "", " a  b\tc\n\n d ", "naïve 漢字 😀😀 x\u200d y é " * 30, "don't stop  now", "a" * 300]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], DOCS)
    whole = bpe.load(bpe.default_vocabulary(), bpe.default_pattern())
    got = bpe.encode_documents(docs, with_ids=True, with_offsets=True).collect()
    assert len(got) == len(texts)
    for r in got:
        ids, offsets = whole.encode(texts[r.doc_id] or "")
        assert list(memoryview(bytes(r.ids)).cast("I")) == ids and r.n_tokens == len(ids)
        assert list(zip(r.starts, r.ends)) == [tuple(o) for o in offsets]


# ---- quality


def statistics_plain(text):
    ws = [w.decode() for w in words_of(text)]
    seen = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    covered = {j for i in range(len(ws) - 2) if seen[tuple(ws[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if x.strip(GAPS)]
    return (len(ws), sum(map(len, ws)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_statistics_equal_brute_force(spark):
    docs = documents(spark, extra=True)
    got = quality.quality_report(docs)
    want = []
    for i, text, *_ in document_rows():
        s = statistics_plain(text)
        want.append((i, *s, s[0] < 50 or 100 * s[4] > 50 * s[0]))
    assert rows_of(got, "doc_id", *quality.STATS[:5], "base_failed") == sorted(want, key=repr)
    assert got.filter("base_failed and kept").count() == 0


def test_outliers_go_and_the_rest_stays(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        n = int(rng.integers(60, 300))
        ws = ["".join(rng.choice(list("abcdefgh"), size=int(rng.integers(2, 9)))) for _ in range(n)]
        if i % 10 == 0:  # a tenth is junk
            ws = [w + "###" for w in ws]
        rows.append((i, " ".join(ws), "en" if i % 3 else None, "hot" if i % 4 else f"s{i}"))
    docs = spark.createDataFrame(rows, DOCS)
    report = {r.doc_id: r for r in quality.quality_report(docs).collect()}
    assert {i for i in report if not report[i].kept} == set(range(0, 400, 10))
    kept = {r.doc_id for r in kept_columns(docs, quality.keep_good(docs)).collect()}
    assert kept == {i for i in range(400) if i % 10}


@pytest.mark.parametrize("share", [30, 40, 44])
def test_outliers_go_when_they_are_a_large_share_of_a_source(spark, share):
    rng = np.random.default_rng(6)
    rows, junk = [], set()
    for i in range(400):
        ws = ["".join(rng.choice(list("abcdefgh"), size=int(rng.integers(2, 9)))) for _ in range(int(rng.integers(60, 200)))]
        if i % 100 < share:
            junk.add(i)
            ws = [w + "###" for w in ws]
        rows.append((i, " ".join(ws), "en", "hot"))
    report = quality.quality_report(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id for r in report if not r.kept} == junk


def test_least_determinant_of_the_starts_is_kept(spark):
    """Against a plain version: every start's steps while the determinant falls, then the least."""
    rng = np.random.default_rng(12)
    v = np.vstack([rng.normal((1500, 300, 0, 100), (60, 40, 25, 50), (260, 4)), rng.normal((2500, 1500, 400, 300), 90, (160, 4))]).round().astype(int)
    rows = spark.createDataFrame([("en", "hot", *map(int, r)) for r in v], "lang string, source string, v0 long, v1 long, v2 long, v3 long")
    got = quality.fit_groups(rows)[1].first()

    def factor(cov):
        return np.linalg.cholesky(cov + np.diag([f ** 2 for f in quality.FLOORS]))
    def bins(m, low):
        return np.floor(np.log1p((np.linalg.solve(low, (v - m).T) ** 2).sum(0)) * quality.BINS)
    quarter, half, three = (np.quantile(v, q, axis=0) for q in (0.25, 0.5, 0.75))
    width = np.diag(((three - quarter) / 1.349) ** 2)
    found = []
    for m, cov in ((half, width), (v.mean(0), np.diag(v.var(0))), (quarter, width)):
        low, det = factor(cov), np.inf
        for _ in range(quality.MAX_STEPS):
            b = bins(m, low)
            cut = np.sort(b)[int(np.ceil(len(v) * quality.CORE_SHARE)) - 1]
            core = v[b <= cut]
            new = factor(np.cov(core.T, bias=True))
            new_det = np.prod(np.diag(new) ** 2)
            if new_det >= det:
                break
            m, low, det = core.mean(0), new, new_det
        found.append((det, *m))
    assert [got.det, got.m0, got.m1, got.m2, got.m3] == pytest.approx(min(found))


# ---- exact dedup


def test_index_persists_over_batches(spark, tmp_path):
    name = exact_dedup.create_index(spark, "test_digest_index", str(tmp_path / "index"), buckets=4)
    try:
        first = spark.createDataFrame([(1, "Abc", "en", "s"), (2, "aBC", "en", "s"), (3, None, "en", "s"), (4, "ÀB", "en", "s")], DOCS)
        second = spark.createDataFrame([(9, "abc", "en", "s"), (10, "new", "en", "s"), (11, "New", "en", "s"), (12, "àb", "en", "s"), (13, "", "en", "s")], DOCS)
        empty = spark.createDataFrame([], DOCS)
        assert [r.doc_id for r in exact_dedup.dedup_against(first.withColumn("digest", F.lit(1)), name).orderBy("doc_id").collect()] == [2, 3, 4]
        assert exact_dedup.dedup_against(empty, name).count() == 0
        assert [r.doc_id for r in exact_dedup.dedup_against(second, name).orderBy("doc_id").collect()] == [11, 12]
        assert exact_dedup.read_index(spark, name).count() == 5
    finally:
        spark.sql(f"DROP TABLE {name}")


def plain_lm(docs, held, rounds):
    """The model token by token, with Python integers and one dictionary of weights."""
    import zlib
    from collections import Counter, defaultdict
    texts = {i: (t or "").encode().lower().split() + [b""] for i, t in docs}
    count = Counter(w for i, ws in texts.items() if not held(i) for w in ws)
    n, v = sum(count.values()), len(count)
    own = {w: k for k, (w, _) in enumerate(sorted(count.items(), key=lambda x: (-x[1], x[0]))[:lm.OWN_BUCKETS])}
    bucket = lambda w: own[w] if w in own else lm.shared_bucket(w.decode())
    tokens, words = Counter(), Counter()
    for w, c in count.items():
        tokens[bucket(w)] += c
        words[bucket(w)] += 1
    sizes = np.array([tokens[b] + 1.0 for b in range(lm.BUCKETS)]).reshape(lm.CLASSES, lm.MEMBERS)
    bias = [np.log(sizes.sum(1) / sizes.sum()), np.log(sizes / sizes.sum(1, keepdims=True))]

    def mix(a, b):
        x = (a * 0x9E3779B1 & 0xFFFFFFFF) ^ b
        x = ((x ^ x >> 15) * 0x85EBCA77) & 0xFFFFFFFF
        return x ^ x >> 13

    def events(ws):
        for at, w in enumerate(ws):
            one, two = (zlib.crc32(ws[at - k]) if at >= k else lm.START for k in (1, 2))
            features = [mix(one, 1), mix(two, 2), mix(one, mix(two, 3))]
            cls, member = divmod(bucket(w), lm.MEMBERS)
            yield w, cls, member, [[(0, k, f % lm.ROWS) for k, f in enumerate(features)],
                                   [(1, k, mix(f, cls + 7) % lm.ROWS) for k, f in enumerate(features)]]
    weights = defaultdict(lambda: np.zeros(lm.MEMBERS))

    def probabilities(layer, rows, cls):
        z = sum((weights[r] for r in rows), bias[1][cls] if layer else bias[0])
        return np.exp(z) / np.exp(z).sum()
    for _ in range(rounds):
        seen, want = (defaultdict(lambda: np.zeros(lm.MEMBERS)) for _ in range(2))
        for i, ws in texts.items():
            if not held(i):
                for _, cls, member, rows in events(ws):
                    for layer, y in ((0, cls), (1, member)):
                        p = probabilities(layer, rows[layer], cls)
                        for r in rows[layer]:
                            seen[r][y] += 1
                            want[r] += p
        for r in seen:
            step = (seen[r] - want[r]) / (0.5 * (seen[r] + want[r]) + lm.PRIOR)
            weights[r] = weights[r] + np.clip(step, -lm.MAX_STEP, lm.MAX_STEP) / lm.FEATURES * 1.5
    return {i: sum(np.log10(probabilities(0, rows[0], cls)[cls]) + np.log10(probabilities(1, rows[1], cls)[member])
                   + np.log10((count[w] + 1) / (tokens[bucket(w)] + words[bucket(w)] + 1)) for w, cls, member, rows in events(ws))
            for i, ws in texts.items()}


@pytest.mark.parametrize("rounds", [2, 3])
def test_lm_scores_equal_a_plain_model(spark, monkeypatch, rounds):
    monkeypatch.setattr(lm, "BLOCK", 64)
    monkeypatch.setattr(lm, "BATCH", 16)
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(0, 50)), "en", "s") for i in range(60)]
    rows += [(60 + i, rows[3][1], "en", "s") for i in range(20)] + [(90, None, "en", "s"), (91, "Ünï 漢字 unseen-word A A A", "de", "s")]
    held = F.col("doc_id") % 5 == 2
    got = {r.doc_id: r.score for r in lm.lm_scores(documents(spark, rows=rows), held, rounds).collect()}
    want = plain_lm([r[:2] for r in rows], lambda i: i % 5 == 2, rounds)
    assert got.keys() == want.keys()
    assert all(got[i] == pytest.approx(want[i], rel=1e-4, abs=1e-3) for i in want)


def test_expected_counts_of_distinct_tuples_equal_those_of_tokens():
    rng = np.random.default_rng(4)
    model = lm.Model({}, np.arange(lm.BUCKETS) * 1.0, np.ones(lm.BUCKETS))
    model.weights += rng.normal(0, 0.3, model.weights.shape).astype(np.float32)
    n = 70_000
    rows = [rng.integers(0, 9 if k else 4096, n).astype(np.uint16) for k in range(3)]
    cls = rng.integers(0, lm.CLASSES, n)
    for layer in (0, 1):
        expected = np.zeros((2, 3, lm.ROWS, lm.MEMBERS))
        lm.add_expected(model, layer, rows, cls, expected)
        p, total = model.layer(layer, rows, cls)
        for k in range(3):
            plain = np.zeros((lm.ROWS, lm.MEMBERS))
            np.add.at(plain, rows[k], p / total[:, None])
            assert np.allclose(expected[layer, k], plain, rtol=1e-4, atol=1e-3)


def test_report_on_later_batches(spark, tmp_path):
    name = exact_dedup.create_index(spark, "test_digest_batches", str(tmp_path / "index"), buckets=4)
    def batch(rows):
        return spark.createDataFrame([(i, t, "en", "s") for i, t in rows], DOCS)
    def seen(report):
        return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in report.collect()), key=repr)
    try:
        assert seen(exact_dedup.dedup_report(batch([(1, "A"), (2, "b")]), name, "first")) == [(1, 1, 1, True), (2, 2, 1, True)]
        later = batch([(5, "a"), (6, "a"), (None, "c")])
        want = [(5, 6, 3, False), (6, 6, 3, True), (None, None, 1, True)]
        assert seen(exact_dedup.dedup_report(later, name, "second")) == sorted(want, key=repr)
        assert seen(exact_dedup.dedup_report(later, name, "second")) == sorted(want, key=repr)  # a load that ran twice
        hot = batch([(100 + i, "A") for i in range(500)] + [(3, "c")])
        got = seen(exact_dedup.dedup_report(hot, name, "third"))
        assert got[0][:3] in {(100, 599, 503), (3, 3, 2)} and {g[1:3] for g in got} == {(599, 503), (3, 2)}
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_index_is_bucketed_by_size_and_query_drops_it(spark, tmp_path):
    assert exact_dedup.buckets_for(10) == exact_dedup.LEAST_BUCKETS
    assert exact_dedup.buckets_for(30_000_000) * exact_dedup.BUCKET_ROWS >= 300_000_000
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    before = {t.name for t in spark.catalog.listTables()}
    assert exact_dedup.op10_exact_dedup(spark, str(tmp_path)).count() == documents(spark).count()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_broadcast_bound_counts_what_arrays_and_structs_hold(spark):
    from pyspark.sql import functions as F

    from snaplytics.llm.common import broadcast_if_small
    def hinted(df, limit):
        return "ResolvedHint" in broadcast_if_small(df, limit)._jdf.queryExecution().analyzed().toString()
    one = spark.range(10)
    big = one.select(F.sequence(F.lit(1), F.lit(10_000)).alias("a"))                          # 80 kB a row
    deep = one.select(F.struct(F.array(F.struct(F.repeat(F.lit("x"), 9000).alias("t"))).alias("s")).alias("d"))
    none = one.select(F.lit(None).cast("array<struct<t:string>>").alias("a"), F.lit(None).cast("map<string,int>").alias("m"))
    for df, size in ((big, 800_000), (deep, 90_000)):
        assert not hinted(df, size - 1000) and hinted(df, 2 * size)
    assert hinted(none, 1000)


# ---- empty tables


@pytest.mark.parametrize("run", [
    mixing.mix_report, mixing.mix_sources, simhash.simhash_report, simhash.dedup, bpe.encode_documents, line_dedup.line_report,
    line_dedup.dedup_lines, quality.quality_report, quality.keep_good, lambda d: lm.lm_scores(d, F.lit(False))])
def test_empty_table_gives_empty_result(spark, run):
    assert run(documents(spark, extra=True, rows=[])).collect() == []


def test_clash_list_is_used(spark):
    assert set(CLASH) < set(documents(spark, extra=True).columns)


def test_frequent_words_are_not_shuffled_and_sums_leave_no_shuffle_files(spark, monkeypatch):
    """Words whose counts all tasks have are left out before the join on rarer words; the rounds' sums are staged."""
    names = []
    monkeypatch.setattr(lm, "staged", lambda df, name, *a, **k: names.append(name) or staged(df, name, *a, **k))
    out = lm.lm_scores(documents(spark), F.lit(False))
    assert "LeftAnti" in out._jdf.queryExecution().optimizedPlan().toString() and names.count("lm-sums") == lm.ROUNDS


@pytest.mark.parametrize("block", [64, 1 << 18])
def test_probabilities_are_added_up_by_row(monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK", block)
    monkeypatch.setattr(lm, "BATCH", 32)
    rng = np.random.default_rng(4)
    model = lm.Model({}, rng.integers(1, 9, lm.BUCKETS), np.ones(lm.BUCKETS))
    model.weights = rng.normal(0, 0.3, model.weights.shape).astype(np.float32)
    rows, cls = [rng.integers(0, 40, 500).astype(np.uint16) for _ in range(lm.FEATURES)], rng.integers(0, lm.CLASSES, 500)
    got = np.zeros((2, lm.FEATURES, lm.ROWS, lm.MEMBERS))
    for layer in (0, 1):
        lm.add_expected(model, layer, rows, cls, got)
        e, total = model.layer(layer, rows, cls)
        for k, r in enumerate(rows):
            want = np.zeros((lm.ROWS, lm.MEMBERS))
            np.add.at(want, r, e / total[:, None])
            assert np.allclose(got[layer, k], want, rtol=1e-4, atol=1e-5)


def test_lm_exponentials_are_of_weights_and_not_of_tokens(monkeypatch):
    """They are taken once for all tokens, until a step changes the weights."""
    taken, exp = [], np.exp
    rng = np.random.default_rng(5)
    model = lm.Model({}, rng.integers(1, 9, lm.BUCKETS), np.ones(lm.BUCKETS))
    rows, cls = [rng.integers(0, lm.ROWS, 2000).astype(np.uint16) for _ in range(lm.FEATURES)], rng.integers(0, lm.CLASSES, 2000)
    monkeypatch.setattr(np, "exp", lambda x, *a, **k: taken.append(np.size(x)) or exp(x, *a, **k))
    for _ in range(2):
        touched = np.arange(2 * lm.FEATURES * lm.ROWS)
        model.step(touched, *rng.integers(0, 20, (2, len(touched), lm.MEMBERS)))
        taken.clear()
        for _ in range(20):
            got = [model.layer(layer, rows, cls) for layer in (0, 1)]
        assert sum(taken) <= model.weights.size + 2 * lm.BUCKETS
        for layer, (e, sums) in enumerate(got):
            z = sum(model.weights[layer, k][rows[k]] for k in range(lm.FEATURES)) + (model.member_bias[cls] if layer else model.class_bias)
            assert np.allclose(e, exp(z), rtol=1e-5) and np.allclose(sums, exp(z).sum(axis=1), rtol=1e-5)


def test_lm_sums_of_a_frequent_row_stay_exact(monkeypatch):
    """A row that nearly all tuples share is added up in short pieces, in several blocks."""
    monkeypatch.setattr(lm, "BLOCK", 50_000)
    rng = np.random.default_rng(6)
    model = lm.Model({}, rng.integers(1, 9, lm.BUCKETS), np.ones(lm.BUCKETS))
    model.weights = rng.normal(0, 0.3, model.weights.shape).astype(np.float32)
    n = 120_000
    rows, cls = [np.full(n, 7, np.uint16), rng.integers(0, lm.ROWS, n).astype(np.uint16), rng.integers(0, lm.ROWS, n).astype(np.uint16)], rng.integers(0, lm.CLASSES, n)
    got = np.zeros((2, lm.FEATURES, lm.ROWS, lm.MEMBERS))
    for layer in (0, 1):
        lm.add_expected(model, layer, rows, cls, got)
        z = sum(model.weights[layer, k][rows[k]].astype(float) for k in range(lm.FEATURES)) + (model.member_bias[cls] if layer else model.class_bias)
        p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
        assert np.allclose(got[layer, 0, 7], p.sum(axis=0), rtol=1e-5)
        assert np.allclose(got[layer].sum(axis=(1, 2)), n, rtol=1e-5)


def test_lm_lists_become_arrays():
    import pyarrow as pa

    got = list(lm.cells(pa.array([[3], [1, 2], None, []], pa.list_(pa.int32())).slice(1)))
    assert [None if x is None else x.tolist() for x in got] == [[1, 2], None, []]
    assert next(lm.cells(pa.array([["", "a\0b", "漢"]], pa.list_(pa.string())))).tolist() == ["", "a\0b", "漢"]

"""Near-duplicates, substrings, URL lists, chats and the pipeline: brute force, round trips, odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.llm.chat import escape, format_chats, loss_text, read_back, unescape
from tidegrid.llm.components import components, union_find
from tidegrid.llm.near_dups import MEET, _meetings, near_duplicates, super_minhash
from tidegrid.llm.shingles import shingle_sets
from tidegrid.llm.substrings import covered, doubled, grams, remove_repeats, repeated_runs, sliding_argmin, without_repeats
from tidegrid.llm.url_filter import filter_urls, look_ups, passed

WORD = re.compile("[^\x20\x09-\x0D]+")


def shingles(text: str | None, n: int = 5) -> frozenset:
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def test_shingle_sets_equal_brute_force():
    rng = random.Random(1)
    texts = ["", "one", "one two three four", "A b C d e", "a B c D E\tf", "é É\x0bé"] + [
        " ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(50)]
    _, counts = shingle_sets(texts)
    assert counts.tolist() == [len(shingles(t)) for t in texts]
    sets, counts = shingle_sets(["A b C d e f", "a b c d e g"])
    assert len(np.intersect1d(*np.split(sets, np.cumsum(counts)[:-1]))) == 1


def test_super_minhash_estimates_similarity_with_permutations():
    rng = np.random.default_rng(2)
    errors = []
    for n in (40, 300, 3000):
        base = rng.integers(0, 2 ** 63, 2 * n).astype(np.uint64)
        for share in (0.2, 0.5, 0.8):
            both = int(2 * n * share / (1 + share))
            a, b = base[:n], np.concatenate([base[:both], base[n:2 * n - both]])
            s = super_minhash(np.concatenate([a, b]), np.array([len(a), len(b)]), 256)
            errors.append((s[0] == s[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert np.abs(errors).max() < 0.12 and abs(np.mean(errors)) < 0.03
    one = super_minhash(base[:1], np.array([1, 0]), 64)
    assert sorted((one[0] >> np.uint64(32)).tolist()) == list(range(64))  # one value at each rank: a permutation
    assert (one[1] == one[1][0]).all()


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(30)] + [(100 + i, 101 + i) for i in range(25)] + [(200, 300 + i) for i in range(40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long").repartition(5)).collect()}
    want = {x: r for x, r in union_find(p for p in pairs if p[0] != p[1]).items()}
    assert {x: got.get(x, x) for x in want} == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_components(rows):
    sets = {d: shingles(t) for d, t in rows}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = union_find(pairs)
    return {d: root.get(d, d) for d in sets}, sets


def family(rng, n, edits):
    base = [rng.choice(["stone", "river", "amber", "field", "quiet"]) + str(rng.randrange(50)) for _ in range(n)]
    for k in edits:
        own = list(base)
        for _ in range(k):
            own[rng.randrange(n)] = "x" + str(rng.randrange(10 ** 6))
        yield " ".join(own)


@pytest.mark.parametrize("seed", range(2))
def test_near_duplicates_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = ["", None, " \n", "one", "ONE", "a b c d e", "a b c d e"]
    for n, edits in ((100, [0] * 9 + [1] * 20 + [2] * 25 + [3] * 25 + [4] * 10), (30, range(6)), (400, [k for k in range(0, 20)])):
        texts += family(rng, n, edits)
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS key", "1 AS n").repartition(4)
    got = {r["doc_id"]: r for r in near_duplicates(df).collect()}
    want, sets = brute_components(rows)
    assert {d: r["component_id"] for d, r in got.items()} == want
    assert all(r["n_shingles"] == len(sets[d]) and r["kept"] == (want[d] == d) for d, r in got.items())


FRONT = "id long, g long, token long, n long, room long"


@pytest.mark.parametrize("full", [1, 4_000_000])
def test_meetings_are_the_pairs_that_size_and_place_allow(spark, full):
    rng = random.Random(7)
    rows = {}
    for i in range(400):
        n = rng.choice([1, 2, 3, 4, 7, 20, 21, 26, 27, 28, 90, 100, 101, 119, 120, 133, 134])
        for token in rng.sample(range(3), 2):
            room = rng.randint(-(-3 * n // 4), n)
            rows[i, token] = (i, rng.choice([1, 2, 3, i]) if token else i % 5, token, n, room)
    left, right = _meetings(spark.createDataFrame(list(rows.values()), FRONT), 75, full)
    met = left.join(right, MEET).where("(na < nb OR na = nb AND ida < idb) AND nb <= capa AND na <= capb")
    got = Counter((r["token"], *sorted((r["ida"], r["idb"]))) for r in met.collect())
    want = Counter((t, i, j) for (i, t), a in rows.items() for (j, u), b in rows.items()
                   if t == u and i < j and a[1] != b[1] and 175 * min(a[4], b[4]) >= 75 * (a[3] + b[3])
                   and 100 * min(a[3], b[3]) >= 75 * max(a[3], b[3]))
    assert got == want and len(want) > 1000


def test_sets_of_one_group_or_too_far_behind_are_never_compared(spark):
    group = [(i, 1, 5, 100, 95) for i in range(3000)] + [(5000, 2, 5, 100, 95), (5001, 3, 5, 100, 95)]
    behind = [(10_000 + i, 10_000 + i, 6, 100, 80) for i in range(3000)]
    left, right = _meetings(spark.createDataFrame(group + behind, FRONT), 75)
    compared = left.join(right, MEET).groupBy("token").count().collect()
    # each pair of groups from both sides: 3000 with each of the two others, and those two with each other
    assert [tuple(r) for r in compared] == [(5, 2 * (2 * 3000 + 1))]


def test_near_duplicates_of_odd_tables(spark):
    schema = "doc_id int, text string"
    assert near_duplicates(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (2, "a b c d e f"), (9, None)]
    got = sorted(near_duplicates(spark.createDataFrame(rows, schema)).collect(), key=str)
    assert Counter((r["doc_id"], r["component_id"], r["kept"]) for r in got) == Counter(
        {(None, None, True): 2, (4, 2, False): 2, (2, 2, True): 1, (9, 9, True): 1})


def test_sliding_argmin_is_leftmost():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 5, 200).astype(np.uint64) << np.uint64(40)
    for width in (1, 2, 7, 50, 200):
        want = [i + int(values[i:i + width].argmin()) for i in range(len(values) - width + 1)]
        assert sliding_argmin(values, width).tolist() == want


def test_doubled_identifiers_tell_strings_apart():
    raw = np.frombuffer(b"abababcabababcababab" * 3, np.uint8)
    ids = doubled(grams(raw, 3)[1], 3, 10)
    text = raw.tobytes()
    strings = [text[i:i + 10] for i in range(len(text) - 9)]
    assert len(ids) == len(strings)
    assert [[a == b for b in strings] for a in strings] == (ids[:, None] == ids[None, :]).tolist()


def brute_repeats(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (doc, _), d in zip(rows, data):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        out.append((doc, len(d), edges[::2].tolist(), edges[1::2].tolist(), bytes(np.frombuffer(d, np.uint8)[~gone])))
    return sorted(out, key=str)


@pytest.mark.parametrize("length,q,seed", [(20, 6, 0), (20, 6, 1), (40, 13, 2), (200, 50, 3)])
def test_remove_repeats_equals_brute_force(spark, length, q, seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abé ") for _ in range(rng.randrange(length // 2, 4 * length))) for _ in range(6)]
    rows = [(None, "x" * (3 * length)), (1, None), (1, ""), (2, "ab" * length), (3, "q" * length), (4, "q" * length)]
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(4)):
            p = list(rng.choice(passages))
            if rng.random() < 0.5:
                p[rng.randrange(len(p))] = rng.choice("xyz")
            cut = rng.randrange(len(p))
            parts.append("".join(p if rng.random() < 0.5 else p[cut:]) + "".join(rng.choice("defg") for _ in range(rng.randrange(30))))
        rows.append((10 + i, "".join(parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS k", "2 AS b").repartition(3)
    got = [(r["doc_id"], r["n_bytes"], r["begins"], r["ends"], bytes(r["kept"])) for r in
           remove_repeats(df, length=length, q=q).collect()]
    want = brute_repeats(rows, length)
    assert sorted(got, key=str) == want
    assert any(w[2] for w in want) and any(w[4] for w in want)
    cut = without_repeats(df, length=length, q=q)
    assert cut.columns == ["doc_id", "text", "k", "b"]
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    for doc, n, begins, ends, kept in want:
        if doc is not None and doc >= 10 and not begins:
            assert texts[doc].encode() == kept


def test_copies_of_a_text_are_folded_before_their_runs_are_listed(spark):
    rng = random.Random(12)
    text, other = ("".join(rng.choice("abcdefgh ") for _ in range(900)) for _ in range(2))
    rows = [(i, text) for i in range(40)] + [(40, other), (41, other[100:400] + text[300:600] + "x" * 9), (None, text), (None, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    keyed = docs.selectExpr("xxhash64(doc_id) AS tag", "text", "xxhash64(text) AS k", "octet_length(text) AS b")
    lists = {r["b"]: r for r in repeated_runs(keyed.where(F.col("text") != other), 40, 13).collect()}
    assert (lists[900]["starts"], lists[900]["counts"]) == ([0], [861])
    assert len(lists[609]["starts"]) == len(set(lists[609]["starts"]))
    got = [(r["doc_id"], r["n_bytes"], r["begins"], r["ends"], bytes(r["kept"])) for r in
           remove_repeats(docs, length=40, q=13).collect()]
    assert sorted(got, key=str) == brute_repeats(rows, 40)


def test_remove_repeats_of_an_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        remove_repeats(spark.createDataFrame([], "doc_id long, text string"), length=10, q=10)


def test_covered_merges_touching_ranges():
    assert covered(np.array([30, 0, 5]), np.array([1, 2, 1]), 10).tolist() == [[0, 15], [30, 40]]


URLS = [None, "", "no scheme", "http://Example.NET/en/1?x#y", "https://a.example.net/de", "x://net", "http://net/", "http://planet/",
        "http://a.example.com/de/x", "http://example.com/d", "http://q.org/fr/", "http://q.org?/fr/", "http://spam.example.org/x",
        "http://SPAM.example.org#z", "a://b://spam.example.org/", "http://user@example.net:80/en/", "http://" + "a." * 500 + "net/"]
LIST = [("net/", "block", 1), ("example.net/en/", "allow", 1), ("example.com/de/", "block", 1), ("org/fr/", "allow", 1),
        ("spam.example.org/", "block", 0), ("net/", "block", 1), (None, "block", 1), ("", "block", 2), ("q.org", "block", 0),
        ("a.example.net", "block", 0)]


def brute_verdict(url, listed=LIST):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    host = host.translate({c: c + 32 for c in range(65, 91)})
    fit = [(p, len(e), e, v) for e, v, p in listed
           if e and ("." + host).endswith("." + e.split("/")[0]) and path.startswith(e[len(e.split("/")[0]):])]
    best = max(fit, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("max_blocks, max_shapes", [(1, 256), (1 << 18, 256), (1, 2), (1 << 18, 0)])
def test_url_verdicts_equal_brute_force(spark, max_blocks, max_shapes):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[3])] * 2
    pages = spark.createDataFrame([(i, u, "host", "entry") for i, u in rows], "page_id long, url string, host string, entry string")
    listed = spark.createDataFrame(LIST, "entry string, verdict string, priority int")
    got = filter_urls(pages, listed, max_blocks=max_blocks, max_shapes=max_shapes).collect()
    assert Counter((r[0], *r[1:]) for r in got) == Counter((i, *brute_verdict(u)) for i, u in rows)
    assert filter_urls(pages.where("false"), listed).collect() == []
    assert {r["verdict"] for r in filter_urls(pages, listed.where("false"), max_shapes=max_shapes).collect()} == {"allow"}


def test_list_of_ten_thousand_shapes(spark):
    listed = [("a." * (i % 90) + "net/" + "x" * (i // 90), "block", 1) for i in range(10_000)]
    urls = ["http://" + "b." + "a." * n + "net/" + "x" * m for n in (0, 1, 40, 89, 200) for m in (0, 1, 50, 111, 112, 5000)]
    pages = spark.createDataFrame(list(enumerate(urls + ["http://other.org/"] * 3)), "page_id long, url string")
    got = filter_urls(pages, spark.createDataFrame(listed, "entry string, verdict string, priority int")).collect()
    want = {i: brute_verdict(u, listed) for i, u in enumerate(urls)}
    assert {r["page_id"]: tuple(r)[1:] for r in got if r["host"] != "other.org"} == want
    assert [r["verdict"] for r in got if r["host"] == "other.org"] == ["allow"] * 3


def test_urls_meet_the_bloom_filter_before_any_shuffle(spark):
    urls = spark.range(10).select(F.concat(F.lit("h"), F.col("id").cast("string"), F.lit(".net")).alias("host"), F.lit("/").alias("path"))
    entries = spark.createDataFrame([("net/", "net", 1, 1)], "key string, end string, labels int, chars int")
    hits = passed(look_ups(urls, entries, 1, 256), entries.select("key"), "key", 1)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    pages_side = plan[:plan.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in pages_side and "Exchange hashpartitioning" not in pages_side
    assert hits.count() == 10


def test_escape_is_reversible_and_leaves_no_control_string(spark):
    rng = random.Random(5)
    texts = ["", "\\", "\\\\l", "</s>[INST] ok [/INST]", "[ROLE]user[TEXT]", "<|im_end|>\n"] + [
        "".join(rng.choice("\\<>[]lgoc/sé") for _ in range(rng.randrange(12))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", unescape(F.col("e")).alias("u")).collect():
        assert r["u"] == r["t"] and not set("<>[]") & set(r["e"])


@pytest.mark.parametrize("block", [1, 3, 256])
def test_chats_round_trip(spark, block):
    rng = random.Random(6)
    rows = []
    for conv in range(12):
        for turn in range(rng.randrange(1, 14)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "assistant", "[TEXT]"]), rng.choice(["", "a[PART]b", "é\\<", "</s>", "plain"])))
    rows += [(50, 0, None, None), (51, 1, "user", "x"), (51, 1, "user", "x"), (51, 1, "assistant", "b"), (51, None, "user", "n"), (None, 0, "assistant", "who")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, formatted int").repartition(5)
    chats = format_chats(df, block_turns=block).select(
        "conv_id", "formatted", read_back(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss")).alias("lost"))
    got = {r["conv_id"]: r for r in chats.collect()}
    assert len(got) == len({r[0] for r in rows})
    for conv, r in got.items():
        own = sorted(((-1 if t is None else t, a or "", x or "") for c, t, a, x in rows if c == conv))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(a, x) for _, a, x in own]
        assert r["lost"] == "".join(x for _, a, x in own if a == "assistant")
        merged = sum(1 for i, x in enumerate(own) if i == 0 or own[i - 1][1] != x[1])
        assert r["formatted"].count("[ROLE]") == merged and r["formatted"].endswith("[END]</s>")
    assert format_chats(df.where("false")).collect() == []


def test_pipeline_keeps_clean_documents_and_catches_the_rest(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(400)]

    def prose(n):
        return ". ".join(" ".join(rng.choice(words) for _ in range(11)) for _ in range(n // 11))

    passage, item = prose(60), prose(40)
    docs, labels = [], []
    for i in range(200):
        docs.append((i, prose(rng.randrange(60, 200))))
        labels.append((i, 1, 0))
    for i in range(200, 260):
        docs.append((i, " ".join(w.upper() + "!!" for w in prose(80).split())))
        labels.append((i, 0, 0))
    docs += [(300, docs[5][1]), (301, docs[5][1]), (302, docs[6][1].replace("a", "a", 1) + " end")]
    docs += [(310 + i, prose(60) + "\n" + passage + "\n" + prose(60)) for i in range(3)]
    docs += [(320, prose(50) + " " + item.upper() + " " + prose(50)), (330, None), (None, prose(80))]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage_of in corpus_pipeline.STAGES:
        after = stage_of(spark, now, str(tmp_path))
        if name != "packing":
            assert after.columns == now.columns
        after.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r["doc_id"]: r for r in now.collect()}
    clean = set(range(200))
    assert clean <= set(seen["quality"]) and not set(range(200, 260)) & set(seen["quality"])
    assert set(seen["quality"]) - set(seen["near_dedup"]) == {300, 301, 302}
    assert set(seen["substring_dedup"]) == set(seen["near_dedup"])
    for d, r in seen["substring_dedup"].items():
        if d in clean:
            assert r["text"] == seen["near_dedup"][d]["text"]
        if d in (310, 311, 312):
            assert passage not in r["text"] and r["n_chars"] == len(r["text"]) < len(seen["near_dedup"][d]["text"])
    assert set(seen["substring_dedup"]) - set(seen["decontamination"]) == {320}
    assert set(seen["packing"]) == set(seen["decontamination"])
    ran = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(r["doc_id"] for r in ran.collect()) == Counter(r["doc_id"] for r in now.collect())
    assert corpus_pipeline.ORACLE_SQL is None


def test_given_tables_agree_with_the_contracts(spark):
    from tidegrid.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op5_substring_dedup"](spark, sf).collect()
    want = {d: (n, sum(e) - sum(b), len(b), hashlib.sha256(k).hexdigest()) for d, n, b, e, k in brute_repeats(list(docs.items()), 200)}
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows} == want

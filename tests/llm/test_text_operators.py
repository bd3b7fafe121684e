"""Packing, token counts, quality rules and model, licences, decontamination: brute force, round trips, odd rows."""

from __future__ import annotations

import random
import re
import time
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidegrid.llm.crf import Crf, fit_crf, gradient, viterbi
from tidegrid.llm.decontaminate import contaminations, distance_in, normalised, without_contaminated
from tidegrid.llm.gam import fit_gam
from tidegrid.llm.licenses import TEMPLATES, fit_licences, plain, scan_licences
from tidegrid.llm.packing import Packer, closest_fill, pack
from tidegrid.llm.quality_model import score_quality
from tidegrid.llm.quality_rules import base_counts, judge_quality
from tidegrid.llm.token_counts import count_tokens, resynchronised
from tidegrid.llm.word_encoder import WordEncoder, slices

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "a", "it's <|endoftext|>x <|startoftext|>'re “!'s”", "x" * 5000, "é" * 3000 + " a " * 3000, " " * 3000,
       "H̱x. ẗ, <|EndOfText|> a.b. c.. d!\n", "İ ΑΣ  Σ́ á\n\n\tq\x1cb\x85c d", "ab'll " * 900, "𝔘nicode👍🏽 ñ" * 300,
       "One. Two, three!\nOne. Two, three!"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def docs(spark):
    """Odd texts, a null text, repeated rows, a missing id, and columns whose names the results use too."""
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (3, ODD[3]), (3, ODD[3]), (None, "no id here")]
    return spark.createDataFrame([(i, t, "en", -1) for i, t in rows], "doc_id long, text string, score string, n_tokens int")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def rng_texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("ab' \n.!<|endoftext|>1é́ıΣ\t\x85Ab") for _ in range(rng.randrange(900))) for _ in range(n)]


def test_word_encoder_equals_the_library(tokenizer):
    texts = ODD + rng_texts(1, 40)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for encoder in (WordEncoder(PATH), WordEncoder(PATH, max_words=30, max_chars=200)):
        for _ in range(2):
            assert [x.tolist() for x in encoder.ids(texts)] == want
            assert encoder.counts(texts).tolist() == list(map(len, want))
    assert encoder.ids([]) == [] and len(encoder.counts([])) == 0


def test_slices_keep_the_text():
    for t in ODD:
        for limit in (1, 7, 1000):
            assert "".join(slices(t, limit)) == t


@pytest.mark.parametrize("chunk,overlap", [(64, 8), (500, 40)])
def test_resynchronised_chunks_equal_the_whole(tokenizer, chunk, overlap):
    for t in ODD + rng_texts(2, 30):
        want = tokenizer.encode(t, add_special_tokens=False).ids
        assert np.concatenate(list(resynchronised(tokenizer, t, chunk, overlap))).tolist() == want


def test_token_counts(docs, empty, tokenizer):
    got = count_tokens(docs, PATH, limit=100, chunk=200, overlap=20).collect()
    rows = docs.collect()
    want = sorted((str(r[0]), len((r[1] or "").encode()), len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == want
    assert all(r[3] == (r[2] > 100) for r in got)
    assert count_tokens(empty, PATH).collect() == []
    with pytest.raises(ValueError):
        count_tokens(docs, PATH, chunk=5, overlap=5)


def test_closest_fill_is_the_best_subset_sum():
    rng = random.Random(3)
    for _ in range(200):
        counts = Counter(rng.randrange(1, 40) for _ in range(rng.randrange(0, 9)))
        room = rng.randrange(0, 90)
        items = list(counts.elements())
        best = max(s for k in range(len(items) + 1) for c in combinations(items, k) if (s := sum(c)) <= room)
        fill = closest_fill(counts, room)
        assert sum(n * c for n, c in fill.items()) == best
        assert all(c <= counts[n] for n, c in fill.items())


def _without_blanks(kind: str, n: int) -> str:
    rng = random.Random(kind)
    chars = {"chinese": "的一是不了人我在有他这为之大来以个中上们到说国和地也子时道出而要于就下得可你年生自会那后能对着事其里所去行过家十用发天如然作方成者多日都三小军二无同么经法当起与好看学进种将还分此心前面又定见只主没公从",
             "tabs": "abcdefgh\t", "signs": "!?.,;:#$%&*()'-", "digits": "0123456789", "letters": "abcdefghijklmnopqrstuvwxyzéöñ",
             "quotes": "'stremvld", "marks": "ae\u0301\u0308\u1100\u1161o", "mixed": "ab1!é的'\u0301Z"}[kind]
    return "".join(rng.choice(chars) for _ in range(n))


@pytest.mark.parametrize("kind", ["chinese", "tabs", "signs", "digits", "letters", "quotes", "marks", "mixed"])
@pytest.mark.parametrize("chunk, overlap", [(60, 8), (400, 50)])
def test_chunks_without_blanks_equal_whole_encoding(kind, chunk, overlap):
    tokenizer = Tokenizer.from_file(PATH)
    text = _without_blanks(kind, 6000)
    got = np.concatenate(list(resynchronised(tokenizer, text, chunk, overlap)))
    assert got.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("kind", ["chinese", "signs", "tabs"])
def test_time_without_blanks_is_linear(kind):
    tokenizer = Tokenizer.from_file(PATH)
    text = _without_blanks(kind, 400_000)
    start = time.perf_counter()
    whole = len(tokenizer.encode(text, add_special_tokens=False).ids)
    took = time.perf_counter() - start
    start = time.perf_counter()
    assert sum(map(len, resynchronised(tokenizer, text, 16_384, 512))) == whole
    assert time.perf_counter() - start < 5 * took + 2


@pytest.mark.parametrize("lengths", [[3000], range(2049, 4096), range(1500, 1600), range(1, 4096, 7)])
def test_packer_holds_no_more_than_its_buffer(lengths):
    bound, packer, held, out = 100_000, Packer(4096), 0, 0
    lengths = list(lengths)
    for i in range(400):
        ids = np.full(lengths[i * 37 % len(lengths)], i, "<u4")
        out += sum(len(p[2]) for w in packer.add(i, ids, 0, len(ids)) for p in w)
        if packer.tokens >= bound:
            for window in [*packer.exact(), *packer.cut(bound // 2)]:
                assert sum(len(p[2]) for p in window) == 4096
                out += 4096
            assert packer.tokens <= bound // 2 + 4096
        held = max(held, packer.tokens)
    assert held <= bound + 4096 and out + packer.tokens == sum(lengths[i * 37 % len(lengths)] for i in range(400))


def test_the_table_of_words_forgets_its_older_half():
    encoder, plain = WordEncoder(PATH, max_words=40), Tokenizer.from_file(PATH)
    rng = random.Random(4)
    for _ in range(30):
        text = " ".join("".join(rng.choice("abcdefgh#'") for _ in range(rng.randrange(1, 6))) for _ in range(15))
        assert encoder.ids([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(encoder.index) == len(encoder.length) <= 40
    assert len(encoder.index) > 15


def test_packer_loses_nothing_and_needs_no_padding():
    rng = random.Random(4)
    packer, windows, want = Packer(64), [], {}
    for doc in range(300):
        ids = np.array([rng.randrange(1000) for _ in range(rng.choice([1, 3, 20, 63, 64, 65, 200]))], np.uint32)
        want[doc] = ids
        windows += packer.add(doc, ids, 0, len(ids))
        if packer.tokens > 2000:
            windows += packer.exact()
    windows += [*packer.exact(), *packer.rest()]
    got = defaultdict(dict)
    for w in windows:
        size = sum(len(p[2]) for p in w)
        assert size <= 64 and size & (size - 1) == 0
        for doc, start, ids, total in w:
            assert total == len(want[doc])
            got[doc][start] = ids
    for doc, ids in want.items():
        assert np.array_equal(np.concatenate([got[doc][s] for s in sorted(got[doc])]), ids)


def test_pack_round_trip(docs, empty, tokenizer):
    got = pack(docs.repartition(3), PATH, capacity=256, buffer_tokens=3000).collect()
    sequences, texts = defaultdict(list), Counter()
    for r in got:
        sequences[r["sequence_id"]].append(r)
    pieces = defaultdict(list)
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == np.cumsum([0] + [r["length"] for r in own])[:-1].tolist()
        size = sum(r["length"] for r in own)
        assert size <= 256 and size & (size - 1) == 0
        for r in own:
            assert len(r["ids"]) == 4 * r["length"]
            pieces[r["doc_id"]].append((r["start"], bytes(r["ids"])))
    want = defaultdict(list)
    for r in docs.collect():
        want[r[0]].append(np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4").tobytes())
    for doc, whole in want.items():
        assert b"".join(p for _, p in sorted(pieces[doc])).__len__() == sum(map(len, whole))
        if len(whole) == 1:
            assert b"".join(p for _, p in sorted(pieces[doc])) == whole[0]
    assert set(pieces) == set(want) and not texts
    assert pack(empty, PATH).collect() == []


def brute_counts(t: str):
    word = re.compile("[^\x20\x09-\x0D]+")
    w, seen, dup, windows = word.findall(t), set(), 0, defaultdict(list)
    for line in t.split("\n"):
        if word.search(line):
            dup += line in seen
            seen.add(line)
    for i in range(len(w) - 7):
        windows[tuple(w[i:i + 8])].append(i)
    covered = {j for v in windows.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_base_counts_equal_brute_force():
    rng = random.Random(5)
    texts = ODD + [" ".join(rng.choice("ab") for _ in range(rng.randrange(60))) + rng.choice(["", "\nx\nx", "#"]) for _ in range(60)]
    got = base_counts(texts)
    columns = [got[c].tolist() for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    assert list(zip(*columns)) == [brute_counts(t) for t in texts]


def test_viterbi_and_gradient_equal_brute_force():
    rng = np.random.default_rng(6)
    lengths = np.array([3, 0, 1, 5])
    lines = rng.integers(0, 3, (9, 2))
    model = Crf(rng.normal(size=(2, 3, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))

    def score(rows, y):
        return model.start[y[0]] + sum(model.scores(lines[[r]])[0, a] for r, a in zip(rows, y)) + sum(
            model.move[a, b] for a, b in zip(y, y[1:]))

    label, at, total = viterbi(model, lines, lengths), 0, 0.0
    y = rng.integers(0, 2, 9)
    for n in lengths:
        if n:
            rows = range(at, at + n)
            every = [tuple(int(i >> k & 1) for k in range(n)) for i in range(2 ** n)]
            assert max(every, key=lambda v: score(rows, v)) == tuple(label[at:at + n])
            total += score(rows, tuple(y[at:at + n])) - np.log(sum(np.exp(score(rows, v)) for v in every))
        at += n
    g, value = gradient(model, lines, lengths, y)
    assert value == pytest.approx(total)
    for array, part in ((model.emit, g.emit), (model.move, g.move), (model.start, g.start)):
        i = tuple(0 for _ in array.shape)
        array[i] += 1e-6
        assert (gradient(model, lines, lengths, y)[1] - value) / 1e-6 == pytest.approx(part[i], abs=1e-3)
        array[i] -= 1e-6


def test_crf_learns_runs():
    rng = np.random.default_rng(7)
    label = np.repeat(rng.integers(0, 2, 80), 10)
    lines = np.stack([np.where(rng.random(800) < 0.8, label, 1 - label)], axis=1)
    model = fit_crf(lines, np.full(40, 20), label, 2)
    assert (viterbi(model, lines, np.full(40, 20)) == label).mean() > 0.9 > (lines[:, 0] == label).mean()


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(8)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = fit_gam(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9
    assert fit_gam(np.zeros((0, 3)), np.zeros(0)).score(x).tolist() == [0.5] * 3000
    assert fit_gam(x, np.ones(3000)).score(x[:1])[0] > 0.99


@pytest.fixture(scope="module")
def labelled(spark):
    """Plain texts are good, shouting ones bad."""
    rng = random.Random(9)
    words = ["stone", "river", "walks", "under", "light", "amber", "quiet", "field"]
    rows = []
    for i in range(300):
        own = [rng.choice(words) for _ in range(rng.randrange(30, 80))]
        bad = i % 3 == 0
        text = "\n".join(" ".join(w.upper() + "!!" if bad else w for w in own[k:k + 9]) for k in range(0, len(own), 9))
        rows.append((i, text, int(not bad)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (5, None)], "doc_id long, quality int"), rows


def test_quality_model_on_rows_it_never_saw(labelled, docs, empty):
    good, labels, rows = labelled
    got = {r["doc_id"]: r for r in score_quality(good, labels).collect()}
    for i, _, q in rows:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i]["predicted"] == q and got[i]["predicted"] == int(got[i]["score"] >= 0.3)
    odd = score_quality(docs, labels).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert score_quality(empty, labels).collect() == []
    assert {r["score"] for r in score_quality(docs, labels.where("false")).collect()} == {0.5}


def test_quality_rules(labelled, docs, empty):
    good, labels, rows = labelled
    got = {r["doc_id"]: r for r in judge_quality(good, labels).collect()}
    for i, text, q in rows:
        n, chars, symbols, dup, repeat = brute_counts(text)
        assert (got[i]["n_words"], got[i]["n_repeat_words"]) == (n, repeat)
        assert got[i]["base_failed"] == (n < 20 or 100 * repeat > 30 * n)
        assert got[i]["kept"] == (not got[i]["base_failed"] and bool(q))
    assert len(judge_quality(docs, labels).collect()) == docs.count()
    assert judge_quality(empty, labels).collect() == []
    assert all(r["content_share"] in (0, 1) for r in judge_quality(docs, labels.where("false")).collect())


def test_distance_equals_the_matrix():
    rng = random.Random(10)
    for _ in range(200):
        p = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 25)))
        t = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 50)))
        row = [0] * (len(t) + 1)
        for i, c in enumerate(p, 1):
            new = [i]
            for j, d in enumerate(t, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        assert distance_in(p, t)[0] == min(row)


@pytest.mark.parametrize("block_chars", [10, 10 ** 6])
def test_contaminations_equal_brute_force(spark, docs, empty, block_chars):
    rng = random.Random(11)
    item = ["".join(rng.choice("abcdef ") for _ in range(60)) for _ in range(6)]
    rows = []
    for i in range(60):
        text = list(rng.choice(item)) if i % 2 else []
        for _ in range(rng.randrange(0, 10)):
            if text:
                text[rng.randrange(len(text))] = rng.choice(["", "x", "ab"])
        pad = "".join(rng.choice("abcdef ") for _ in range(80))
        rows.append((i, pad + " " + "".join(text).upper() + " ," + pad))
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([*enumerate(item), (7, None), (8, "too short"), (9, item[0])], "item_id long, text string")
    plainly = lambda t: normalised(pa.array([t]))[0].as_py()
    want = set()
    for n, own in [*enumerate(item), (9, item[0])]:
        p = plainly(own)
        for i, t in rows:
            best = distance_in(p, plainly(t))[0]
            if best <= int(len(p) * 0.1):
                want.add((i, n, best))
    got = contaminations(texts, bench, block_chars=block_chars)
    assert {(r[0], r[1], r[2]) for r in got.collect()} == want and len(want) > 5
    kept = without_contaminated(texts.selectExpr("'x' AS end", "*"), bench, block_chars=block_chars)
    assert kept.columns == ["end", "doc_id", "text"]
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows} - {i for i, _, _ in want}
    assert contaminations(docs, bench).collect() == [] and contaminations(empty, bench).collect() == []
    assert contaminations(docs, bench.where("false")).collect() == []


def test_short_items_and_signs_are_found(spark):
    items = [(1, "What is the capital of France?"), (2, "∑ + ∫ = ∮"), (3, "x^2 + y"), (4, " \n"), (5, "a" * 31 + "!"), (6, "?!"), (7, "what is")]
    texts = [(1, "Quiz:\nwhat is THE capital, of France"), (2, "so ∑  +\n∫ = ∮ holds"), (3, "let x^2+y be"), (4, "what is the capital of Frances"),
             (5, "so ∑ + ∫ = ∮. "), (6, "b" + "a" * 31), (7, None), (8, "a" * 31), (9, "why?!"), (10, "x2 y")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r[0], r[1]): (r[2], r[3]) for r in contaminations(docs, bench).collect()}
    assert got == {(1, 1): (0, 34), (1, 7): (0, 12), (2, 2): (0, 12), (3, 3): (0, 9), (4, 7): (0, 7), (8, 5): (0, 31)}
    kept = {r["doc_id"] for r in without_contaminated(docs, bench).collect()}
    assert kept == {5, 6, 7, 9, 10}


def test_licences(spark, docs, empty):
    rows, want = [], {}
    for f, templates in TEMPLATES.items():
        for t in templates:
            i = len(rows)
            rows.append((i, f"Some words about rivers and stones.\n{t}\nMore of them."))
            want[i] = f
    rows += [(900 + i, t) for i, t in enumerate(["The quiet river walks under amber light.", "A licence to fish is sold here."])]
    got = {r["doc_id"]: r for r in scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, f in want.items():
        assert f in got[i]["families"] and got[i]["similarity"] >= 0.6 and got[i]["n_paragraphs"] == 3
    assert got[900]["families"] == got[901]["families"] == [] and got[900]["score"] is None
    assert len(scan_licences(docs).collect()) == docs.count() and scan_licences(empty).collect() == []


def test_other_licences_are_unknown_and_long_lines_are_searched(spark):
    foreign = ["This work is licensed under the GNU Affero General Public License, version 3.", "Released under the BSD 2-Clause License.",
               "This library is licensed under the GNU Lesser General Public License, version 2.1.", "Licensed under CC BY-NC-SA 4.0.",
               "Licensed under CC BY-ND 4.0.", "Licensed under the Apache License, Version 1.1.", "Released under the ISC License."]
    around = "the quiet river walks under amber light " * 100
    rows = [*enumerate(foreign), (50, f"{around}{TEMPLATES['GPL-3.0'][1]} {around}{TEMPLATES['MIT'][1]}"), (51, around)]
    rows += [(100 + i, f"The quiet river number {i} walks under amber light.") for i in range(200)]
    got = {r["doc_id"]: r for r in scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["families"] for i in range(len(foreign))] == [[]] * len(foreign)
    assert got[50]["families"] == ["GPL-3.0", "MIT"] and got[50]["n_licensed"] == got[50]["n_paragraphs"] == 1
    assert all(r["families"] == [] for d, r in got.items() if d >= 51)


def test_licence_model_knows_garbled_notices():
    model = fit_licences(["the quiet river walks under amber light"] * 50)
    p = model.probabilities([plain("xx Released under (the) MIT License yy"), "walks under amber light"])
    assert model.families[int(p[0].argmax())] == "MIT" and p[1].argmax() == len(model.families)

"""Filter audit, conversation repair and exact duplicates: brute force, odd rows, split groups."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from tidegrid.llm import chat_repair, transducer
from tidegrid.llm.chat_repair import FINAL, LEADS, STATES, parse, product, repair_conversations, repaired_turns, row_cell
from tidegrid.llm.exact_dups import counted_join, counting_filters, exact_duplicates, merge_filters, repeated_prints, text_prints
from tidegrid.llm.filter_audit import audit_filters, audit_orders
from tidegrid.llm.quotient_filter import QuotientFilter, merged, summed
from tidegrid.llm.transducer import text_counts

WORD = re.compile("[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"
TURNS = "conv_id long, turn long, role string, text string"


def bytes_of(texts):
    whole = [t.encode() for t in texts]
    return np.frombuffer(b"".join(whole), np.uint8), np.cumsum([0, *map(len, whole)])


def counts_of(text):
    words = WORD.findall(text)
    return [len(words), len(set(words)), len(text), len(re.findall("[A-Z]", text)), len(re.findall(r"[#$%&*|]", text))]


ODD_TEXTS = ["", " ", "\x0b\n", "a", "A b A", "é É é", "x" * 300, "ab " * 200, "漢字 漢字|", "a\x1cb a\x85b", "\U0001f600 #"]


@pytest.mark.parametrize("limit", [5, 64, 1 << 18])
def test_transducer_equals_patterns(limit):
    rng = random.Random(3)
    texts = ODD_TEXTS + ["".join(rng.choice("ab AB é#|\t\x0b漢") for _ in range(rng.randrange(150))) for _ in range(200)]
    assert text_counts(*bytes_of(texts), limit).tolist() == [counts_of(t) for t in texts]
    assert text_counts(*bytes_of([])).shape == (0, 5)


def test_words_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(transducer, "span_hashes", lambda data, begin, end: np.full(len(begin), 7, np.uint64))
    texts = ["a b a cc", "dd dd", "", "e ff e"]
    assert text_counts(*bytes_of(texts)).tolist() == [counts_of(t) for t in texts]


def audit_by_hand(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = []
    for d, text, source in docs:
        text = text or ""
        words, distinct, points, capitals, symbols = counts_of(text)
        earlier = d is not None and any(e is not None and e < d and (t or "") == text for e, t, _ in docs)
        fails = {x for x, f in zip("ABCDE", (words < 200, 100 * distinct < 50 * words, 100 * capitals > 2 * points, symbols > 0, earlier)) if f}
        rows.append((source or "", fails, d in good, d in toxic))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, x in enumerate(order, 1):
                hit = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                out[part, "".join(order), step] = [
                    len(left), len(hit), sum(x in r[1] for r in gone), sum(r[1] == {x} for r in rows if r[0] == part),
                    sum(r[2] for r in hit), sum(r[3] for r in hit)]
                shapley[part, x] += len(hit)
                gone += hit
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit_equals_brute_force(spark):
    rng = random.Random(5)
    pool = ["", None, "A", "a#", "word " * 250, " ".join(f"w{i}" for i in range(230)), "One Two", " ".join(f"w{i}|" for i in range(230))]
    docs = [(rng.choice([None, *range(60)]), rng.choice(pool), rng.choice(["s", "t", None, ""])) for _ in range(90)]
    labels = [(rng.choice([None, *range(70)]), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(60)]
    got = audit_filters(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)).collect()
    rows = {(r["part"], r["filter_order"], r["step"]): (
        r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"]) for r in got}
    assert len(rows) == len(got) and rows == audit_by_hand(docs, labels)


def test_filter_audit_of_nothing_and_of_clashing_columns(spark):
    labels = spark.createDataFrame([(1, 1, 1)], LABELS)
    assert audit_filters(spark.createDataFrame([], DOCS), labels).count() == 0
    docs = spark.createDataFrame([(1, "a", "s", 5, 6), (2, "a", "s", 5, 6)], DOCS + ", n_words long, quality int")
    got = audit_filters(docs, labels.selectExpr("*", "'x' AS text", "'y' AS source")).where("filter_order = 'EABCD' AND step = 1").first()
    assert (got["kept"], got["removed"], got["good_lost"]) == (1, 1, 0)
    with pytest.raises(ValueError, match="letters"):
        audit_orders(docs, "AA")


def cheapest(rows):
    """Least (cost, audit) by a search over single edits."""
    heap, done = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, at, state = heapq.heappop(heap)
        if at == len(rows) and state in FINAL:
            return cost, audit
        if (at, state) in done:
            continue
        done.add((at, state))
        steps = [(5, "I", at, LEADS[r][state]) for r in "ua" if state in LEADS[r]]
        if at < len(rows):
            initial, must_go, short = rows[at]
            steps.append((2, "D", at + 1, state))
            if not must_go:
                steps += [(5 * short, "K", at + 1, LEADS[initial][state])] if state in LEADS.get(initial, {}) else []
                steps += [(1 + 5 * short, "R", at + 1, LEADS[r][state]) for r in "ua" if state in LEADS[r]]
        for price, letter, k, q in steps:
            heapq.heappush(heap, (cost + price, audit + letter, k, q))


def repair_by_hand(rows):
    rows = sorted(((t is not None, t or 0, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows))
    seen, faults, kinds = set(), Counter(), []
    for _, _, role, text in rows:
        said = WORD.findall(text)
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1][-1] not in ".!?" else None
        seen.add((role, text))
        faults[fault] += 1
        kinds.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    cost, audit = cheapest(kinds)
    turns = {t for there, t, _, _ in rows if there}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    left, state, source = [], 0, iter(rows)
    for edit in audit:
        role, text = next(source)[2:] if edit != "I" else (None, "")
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == 2 else "user"
        state = LEADS[role[:1]][state]
        left.append((role, text))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest), left


def random_turns(rng, n):
    texts = ["Hi.", "Well", "Yes!", "", " \x0b", "No.\n", "Go on?", "é.", None]
    return [(rng.choice([None, *range(12)]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]),
             rng.choice(texts) if rng.random() < 0.7 else f"{rng.random()}.") for _ in range(n)]


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_repairs_equal_a_search_over_edits(spark, block):
    rng = random.Random(block)
    chats = {c: random_turns(rng, rng.randrange(1, 14)) for c in [None, *range(60)]}
    chats[1] = [(i, ("user", "assistant")[i % 2], f"{i}.") for i in range(6)]
    chats[2] = [(i, ("assistant", "tool", "user")[rng.randrange(3)], rng.choice(["Yes.", f"{i}", f"{i}."])) for i in range(300)]
    rows = [(c, *t) for c, own in chats.items() for t in own]
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "'k' AS kind", "'s' AS state").repartition(4)
    repairs = repair_conversations(df, block=block)
    got = {r["conv_id"]: tuple(r)[1:] for r in repairs.collect()}
    want = {c: repair_by_hand(own) for c, own in chats.items()}
    assert got == {c: w for c, (w, _) in want.items()}
    left = defaultdict(list)
    for r in repaired_turns(df, repairs).orderBy("conv_id", "position").collect():
        assert r["position"] == len(left[r["conv_id"]])
        left[r["conv_id"]].append((r["role"], r["text"]))
    assert left == {c: own for c, (_, own) in want.items() if own}


def test_every_cut_of_a_span_gives_the_same_cell():
    rng = random.Random(7)
    for n in (2, 3, 5, 8):
        kinds = "".join(rng.choice(chat_repair.KINDS) for _ in range(n))
        chart = {(i, i + 1): row_cell(k) for i, k in enumerate(kinds)}
        for size in range(2, n + 1):
            for i in range(n - size + 1):
                cells = {product(chart[i, m], chart[m, i + size]) for m in range(i + 1, i + size)}
                assert len(cells) == 1
                chart[i, i + size] = cells.pop()
        assert chart[0, n] == parse(kinds) == parse(kinds, leaf=1)


def test_a_long_conversation_is_parsed_in_blocks():
    rng = random.Random(8)
    kinds = "".join(rng.choice(chat_repair.KINDS) for _ in range(20_000))
    whole, rows = parse(kinds), [(k.lower() if k in "suaSUA" else "-", k == "x", k in "SUA_") for k in kinds]
    assert min(whole[0][q] for q in FINAL if whole[0][q]) == cheapest(rows)
    assert all(parse("")[p][p] == (0, "") for p in STATES)


def test_conversations_without_rows(spark):
    assert repair_conversations(spark.createDataFrame([], TURNS)).count() == 0
    assert repaired_turns(spark.createDataFrame([], TURNS), spark.createDataFrame([(1, "K")], "conv_id long, audit string")).count() == 0


@pytest.mark.parametrize("bits", [3, 9, 24, 63])
def test_quotient_filters_give_back_what_they_hold(bits):
    rng = np.random.default_rng(bits)
    parts = []
    for n in (0, 1, 7, 400, 3000):
        prints = np.unique(rng.integers(0, 2 ** bits, n, dtype=np.uint64))
        counts = np.where(rng.random(len(prints)) < 0.5, 1, rng.integers(1, 100_000, len(prints)))
        filter_ = QuotientFilter.from_bytes(QuotientFilter.of(prints, counts, bits).to_bytes())
        parts.append(filter_.items())
        assert np.array_equal(parts[-1][0], prints) and np.array_equal(parts[-1][1], counts)
    total = Counter()
    for prints, counts in parts:
        total.update(dict(zip(prints.tolist(), counts.tolist())))
    prints, counts = merged(parts)
    assert dict(zip(prints.tolist(), counts.tolist())) == total and (np.diff(prints.astype(np.int64)) > 0).all()
    assert len(summed(np.zeros(0, np.uint64), np.zeros(0, np.int64))[0]) == 0


def test_a_full_quotient_filter_is_compact():
    prints = np.unique(np.random.default_rng(1).integers(0, 2 ** 63, 100_000, dtype=np.uint64))
    ones = np.ones(len(prints), np.int64)
    assert len(QuotientFilter.of(prints, ones, 63).to_bytes()) < 10 * len(prints)


def exact_by_hand(docs):
    lowered = [(d, (t or "").translate({c: c + 32 for c in range(65, 91)})) for d, t, *_ in docs]
    groups = defaultdict(list)
    for d, t in lowered:
        groups[t].append(d)
    out = Counter()
    for d, t in lowered:
        ids = [x for x in groups[t] if x is not None]
        keep = max(ids) if ids else None
        out[d, keep, len(groups[t]), d == keep, hashlib.sha256(t.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("bits", [4, 63])
@pytest.mark.parametrize("split", [False, True])
def test_exact_duplicates_equal_brute_force(spark, bits, split):
    rng = random.Random(bits)
    pool = [*ODD_TEXTS, None, "ß", "SS", "ss", "İ", "i̇", "É", "é", "Long " * 30_000, "long " * 30_000] + [f"t{i}" for i in range(40)]
    docs = [(rng.choice([None, *range(80)]), rng.choice(pool), "x") for _ in range(150)] + [(i, "hot Copy", "x") for i in range(100, 250)]
    df = spark.createDataFrame(docs, "doc_id long, text string, keep_id string").repartition(5)
    limits = {"broadcast_rows": 0, "hot_rows": 20} if split else {}
    got = Counter(tuple(r) for r in exact_duplicates(df, bits=bits, **limits).collect())
    assert got == exact_by_hand(docs)


def test_exact_duplicates_of_other_ids_and_of_nothing(spark):
    rows = exact_duplicates(spark.createDataFrame([("b", "X"), ("a", "x"), ("c", "y")], "name string, body string"), id_col="name", text_col="body")
    assert {(r["name"], r["keep_id"], r["kept"]) for r in rows.collect()} == {("b", "b", True), ("a", "b", False), ("c", "c", True)}
    assert exact_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_filters_of_two_deliveries_merge(spark):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    second = spark.createDataFrame([(3, "A"), (4, "c")], "doc_id long, text string")
    prints = [text_prints(d, "doc_id", "text") for d in (first, second)]
    both = counting_filters(prints[0], 3).unionByName(counting_filters(prints[1], 3))
    found = repeated_prints(merge_filters(both, 3), 3).collect()
    a, = [r["__print"] for r in prints[0].collect() if r["__id"] == 1]
    assert [(r["__print"], r["__n"]) for r in found] == [(a, 2)]


def test_hot_keys_are_cut_into_parts(spark):
    rows = spark.createDataFrame([(i, i % 3 if i < 30 else 7) for i in range(200)], "__id long, k long")
    counted = rows.groupBy("k").count().withColumnRenamed("count", "__n")
    plain = {tuple(r) for r in counted_join(rows, counted, ["k"], "left", 100, 10).collect()}
    assert {tuple(r) for r in counted_join(rows, counted, ["k"], "left", 0, 10).select("k", "__id", "__n").collect()} == plain
    assert counted_join(rows, counted, ["k"], "left_semi", 0, 10).count() == 200

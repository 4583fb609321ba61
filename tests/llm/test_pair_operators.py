"""Operators that compare documents, against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import ODD_TEXTS, documents_from, passage, rows_of  # noqa: F401

from tillroll.llm import backoff_lm, chaining, jaccard_join, suffix_dedup
from tillroll.llm.components import components


def corpus(seed=7, size=60):
    """Distinct texts, exact and near copies, and a passage that many share."""
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    base = [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(80, 160))) for _ in range(size)]
    shared = " ".join(draw.choice(vocabulary) for _ in range(60))
    near = []
    for text in base[:15]:
        words = text.split()
        for _ in range(draw.randint(1, 3)):
            words[draw.randrange(len(words))] = "changed"
        near.append(" ".join(words))
    long = [f"{a} {shared} {b}" for a, b in zip(base[20:40], base[25:45])]
    texts = [*base, *near, *base[:5], *long, *ODD_TEXTS[:8]]
    draw.shuffle(texts)
    return texts


def test_removed_spans_are_those_of_brute_force(documents_from):
    texts = corpus()
    wanted = sorted(suffix_dedup.brute_force(list(enumerate(texts))))
    for shard_bytes in (2_000, 1 << 20):
        found = suffix_dedup.removed_spans(documents_from(texts), shard_bytes)
        assert rows_of(suffix_dedup.digest(found)) == wanted
    assert any(row[2] for row in wanted)


def test_spans_of_repeated_and_missing_ids_and_very_long_runs(spark):
    line = "z" * 300
    rows = [(1, line), (1, line), (None, line), (2, "a" + line), (3, ""), (4, None), (5, "y" * 49), (6, "y" * 50 + "\x00")]
    rows += [(7, "y" * 50), (8, "ab" * 5000), (9, "b" + "ab" * 4000)]
    found = suffix_dedup.removed_spans(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    removed = [(r["doc_id"], r["n_bytes"] - len(r["kept"]), len(r["spans"])) for r in found.collect()]
    assert sorted(removed, key=str) == sorted(
        [(1, 0, 0), (1, 0, 0), (None, 0, 0), (2, 300, 1), (3, 0, 0), (4, 0, 0), (5, 0, 0), (6, 0, 0), (7, 50, 1), (8, 0, 0), (9, 8001, 1)],
        key=str,
    )
    assert suffix_dedup.removed_spans(spark.createDataFrame([], "doc_id BIGINT, text STRING")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_suffix_arrays_and_common_prefixes(seed):
    draw = np.random.default_rng(seed)
    data = draw.integers(97, 97 + 1 + seed, 3000).astype(np.uint8)
    data[1500:2000] = data[200:700]
    order = suffix_dedup.suffix_array(data)
    raw = data.tobytes()
    cut = [raw[i : i + suffix_dedup.DEPTH] for i in order.tolist()]
    assert cut == sorted(cut) and sorted(order.tolist()) == list(range(len(raw)))
    shared = suffix_dedup.common_prefixes(data, order)
    for i in range(1, len(cut)):
        same = next((k for k, (a, b) in enumerate(zip(cut[i - 1], cut[i])) if a != b), min(len(cut[i - 1]), len(cut[i])))
        assert shared[i] == same


def plain_classes(texts, similarity=0.8):
    sets = {}
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
    parent, links = {i: i for i in sets}, dict.fromkeys(sets, 0)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= similarity * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return [(i, root(i), links[i]) for i in sets]


def test_links_and_classes_are_those_of_brute_force(documents_from):
    texts = corpus()
    assert rows_of(jaccard_join.near_duplicates(documents_from(texts))) == plain_classes(texts)


def test_large_groups_of_near_copies_lose_no_link(documents_from, monkeypatch):
    words = passage(1, 120).split()
    texts = []
    for i in range(90):
        own = list(words)
        own[(7 * i) % 100 + 10] = f"changed{i}"
        texts.append(" ".join(own))
    texts += texts[:9]
    # Buckets and blocks so small that every way through the operator is taken.
    monkeypatch.setattr(jaccard_join, "SMALL", 8)
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    monkeypatch.setattr(jaccard_join, "LEVELS", 2)
    assert rows_of(jaccard_join.near_duplicates(documents_from(texts))) == plain_classes(texts)


@pytest.mark.parametrize("settings", [{}, {"ROW_WORK": 0, "SMALL": 48}, {"ROW_WORK": -999, "SMALL": 48, "LEVELS": 3, "LARGE_BLOCK": 32}])
def test_pairs_in_a_group_on_one_template_are_found(documents_from, monkeypatch, settings):
    """Documents that resemble each other below the threshold, with pairs just above it among them: at the settings
    of production, where their buckets are compared whole, where only comparisons count, and where all are split."""
    draw = random.Random(21)
    template = passage(2, 200).split()
    texts = []
    for i in range(300):
        places = draw.sample(range(5, 195, 6), 6)
        base = list(template)
        for place in places[:2]:
            base[place] = f"base{i}x{place}"
        for own in (places[2:4], places[4:]):
            words = list(base)
            for place in own:
                words[place] = f"own{i}x{place}"
            texts.append(" ".join(words))
    wanted = plain_classes(texts)
    assert sum(links > 0 for _, _, links in wanted) >= 600
    for name, value in settings.items():
        monkeypatch.setattr(jaccard_join, name, value)
    assert rows_of(jaccard_join.near_duplicates(documents_from(texts))) == wanted


def test_runs_reach_the_recall_over_all_splits():
    draw = np.random.default_rng(3)
    shared, runs = round(0.8 * jaccard_join.COORDINATES), jaccard_join.runs_for(0.9, 0.8)
    assert jaccard_join.runs_for(0.9, 0.8, repeats=1) > runs >= jaccard_join.runs_for(0.9, 0.8, levels=1)
    together = draw.binomial(shared * runs, 1 / shared, 20_000)
    for _ in range(jaccard_join.LEVELS - 1):
        together = draw.binomial(shared * jaccard_join.REPEATS * together, 1 / shared)
    assert 0.89 <= (together > 0).mean() <= 0.97


def test_one_document_of_each_class_stays(spark, documents_from):
    texts = corpus(seed=8, size=40)
    documents = documents_from(texts)
    kept = jaccard_join.one_of_each(documents)
    assert kept.columns == documents.columns
    assert rows_of(kept, "doc_id") == [(i,) for i, cls, _ in plain_classes(texts) if i == cls]
    again = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None)], "doc_id BIGINT, text STRING")
    assert sorted(r["doc_id"] or 0 for r in jaccard_join.one_of_each(again).collect()) == [0, 1, 2]
    assert jaccard_join.near_duplicates(again.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 100), (300, 300), (None, 5), (41, 60)]
    frame = spark.createDataFrame(edges, "a BIGINT, b BIGINT")
    wanted = sorted([(i, 0) for i in range(41)] + [(41, 41), (60, 41), (100, 100), (200, 100), (300, 300)])
    assert rows_of(components(frame), "node", "component") == wanted
    assert components(frame.limit(0)).count() == 0


def test_scores_are_those_of_brute_force(documents_from):
    texts = [*corpus(seed=9, size=30), *ODD_TEXTS, "Alpha ALPHA alpha Ä", "x" * 5000]
    found = rows_of(backoff_lm.held_out_scores(documents_from(texts)))
    wanted = sorted(backoff_lm.brute_force(list(enumerate(texts))))
    assert [row[:5] for row in found] == [row[:5] for row in wanted]
    for a, b in zip(found, wanted):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_probabilities_after_any_context_add_up():
    words = np.sort(np.array([3, 5, 9, int(backoff_lm._END)], np.uint64))
    counts = np.array([4, 2, 1, 3])
    left = np.repeat(words, 4)
    pairs = backoff_lm.pair_keys(left, np.tile(words, 4))
    order = np.argsort(pairs)
    pair_counts = np.array([2, 1, 0, 1, 0, 0, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0])[order]
    machine = backoff_lm.BackoffAutomaton(words, counts, pairs[order], pair_counts, 4, 10)
    unknown = 0.5 / (10 + 0.5 * 5)
    for state in range(4):  # the context of each word but the last, and none
        total = sum(10 ** machine.step(np.array([state]), np.array([w]))[0][0] for w in range(4))
        assert total + unknown * 10 ** (machine.failure[state] if state else 0) == pytest.approx(1)


def test_scores_of_missing_ids_and_empty_tables(spark):
    frame = spark.createDataFrame([(None, "a b"), (1, None), (1, "a"), (1, "a")], "doc_id BIGINT, text STRING")
    found = backoff_lm.held_out_scores(frame).collect()
    assert len(found) == 4 and {r["n_tokens"] for r in found} == {1, 2, 3}
    assert backoff_lm.held_out_scores(frame.limit(0)).count() == 0


def test_shared_passages_are_found_and_others_are_not(documents_from):
    common = passage(3, 70)
    fuzzy = common.split()
    fuzzy[20:21] = ["other"]
    del fuzzy[45]
    fuzzy.insert(60, "more")
    texts = [
        passage(10, 100) + " " + common + " " + passage(11, 50),
        passage(12, 200),
        common + " " + passage(13, 90),
        passage(14, 30) + " " + " ".join(fuzzy) + " " + passage(15, 40),
        passage(16, 60) + " " + passage(3, 30),
        passage(12, 200),
        *ODD_TEXTS[:6],
    ]
    for shard_bytes in (500, 1 << 20):
        found = {r["doc_id"]: r for r in chaining.shared_passages(documents_from(texts), shard_bytes).collect()}
        assert set(found) == {2, 3, 5}
        assert tuple(found[2])[1:7] == (0, 0, 70, 100, 170, 70)
        assert tuple(found[3])[1:6] == (0, 30, 100, 100, 170) and found[3]["matched"] >= 66
        assert tuple(found[5])[1:4] == (1, 0, 200) and found[5]["identity"] == 1
    assert chaining.shared_passages(documents_from([])).count() == 0


def test_passages_whose_pieces_occur_in_different_earlier_documents_are_found(documents_from):
    texts, wanted = [], {}

    def surrounded(words):
        texts.append(" ".join([passage(100 + len(texts), 20), *words, passage(200 + len(texts), 20)]))

    for start, size, pieces in (
        (3, 60, [(0, 38), (11, 50), (22, 60)]),
        (5, 120, [(i, i + 38) for i in range(0, 101, 16)]),
        (6, 60, [(0, 25), (19, 45), (39, 60)]),
    ):
        words = passage(start, size).split()
        for begin, end in pieces:
            surrounded(words[begin:end])
        first = len(texts)
        surrounded(words)
        for begin, end in pieces:  # the pieces come between, so the last place of each seed is in them as well
            surrounded(words[begin:end])
        wanted[len(texts)] = (first, 20, 20 + size, 20, 20 + size, size)
        surrounded(words)
    again = passage(7, 15)
    texts += [f"{again} {passage(8, 20)} {again} {passage(9, 20)}", f"{again} {passage(8, 20)} {passage(301, 9)}"] * 2
    same = []
    for shard_bytes in (500, 3_000, 1 << 20):
        found = chaining.shared_passages(documents_from(texts), shard_bytes).collect()
        same.append(sorted(map(tuple, found)))
        assert same[-1] == same[0]
        for doc, row in wanted.items():
            assert row in [tuple(r)[1:7] for r in found if r["doc_id"] == doc]


@pytest.mark.parametrize("settings", [{}, {"BLOCK": 3, "TILE": 2, "FEW": 0}, {"PAIRS": 2}])
def test_passages_whose_seeds_are_first_and_last_elsewhere_are_found(documents_from, monkeypatch, settings):
    """Every piece of a passage occurs in a document before the first and in one between the two that hold it."""
    for name, value in settings.items():
        monkeypatch.setattr(chaining, name, value)
    words = passage(5, 60).split()
    changed = [f"changed{i}" if i % 10 == 9 else word for i, word in enumerate(words)]

    def pieces(first):
        return [f"{passage(first + i, 30)} {' '.join(words[i : i + 14])} {passage(first + 100 + i, 30)}" for i in range(0, 50, 5)]

    early, late = pieces(200), pieces(500)
    texts = [*early, f"{passage(300, 40)} {' '.join(words)} {passage(301, 40)}", *late]
    texts += [f"{passage(302, 40)} {' '.join(changed)} {passage(303, 40)}"]
    for shard_bytes in (2_000, 1 << 20):
        found = chaining.shared_passages(documents_from(texts), shard_bytes).collect()
        assert {(row["doc_id"], row["ref_id"]) for row in found} == {(len(texts) - 1, len(early))}
        assert all(row["begin"] <= 42 and row["end"] >= 97 for row in found) and len(found) == 1


def test_chains_that_can_be_no_passage_are_not_fetched(documents_from, monkeypatch):
    """A few words that documents share by chance are no reason to align what is around them."""
    draw, sizes, write = random.Random(5), {}, chaining.materialise

    def fresh(size):
        return [f"w{draw.randrange(10**9)}" for _ in range(size)]

    def counted(frame, name):
        out = write(frame, name)
        sizes[name] = out.filter("seed IS NULL").count() if name == "chains" else None
        return out

    monkeypatch.setattr(chaining, "materialise", counted)
    phrases, shared = [fresh(11) for _ in range(40)], fresh(50)
    texts = [" ".join(word for phrase in draw.sample(phrases, 40) for word in phrase + fresh(70)) for _ in range(3)]
    texts += [" ".join(fresh(30) + shared + fresh(30)) for _ in range(2)]
    for shard_bytes in (2_000, 1 << 20):
        found = chaining.shared_passages(documents_from(texts), shard_bytes).collect()
        assert [tuple(row)[:7] for row in found] == [(4, 3, 30, 80, 30, 80, 50)]
        assert 0 < sizes["chains"] <= 6


def test_signs_leave_room_for_all_equal_words():
    draw = np.random.default_rng(4)
    texts = [" ".join(f"w{n}" for n in draw.integers(0, 3, size)).encode() for size in (5, 30, 70, 90)]
    words = chaining.Words(np.arange(4), texts, np.zeros(0, np.int64))
    at = np.flatnonzero(words.text[: len(words.grams)] == words.text[chaining.K - 1 :])
    a, b = (draw.choice(at, 2000) for _ in range(2))
    begins, ends = words.offsets[words.text], words.offsets[words.text + 1]
    before = np.minimum(a - begins[a], b - begins[b])
    left, right = chaining._fits(words.signs(a), words.signs(b), before, ends[a] - a - chaining.K)
    for i, j, m, n in zip(a.tolist(), b.tolist(), left.tolist(), right.tolist()):
        far, on = min(20, i - begins[i], j - begins[j]), min(20, ends[i] - i - 4, ends[j] - j - 4)
        equal = words.hashes[i - far : i] == words.hashes[j - far : j], words.hashes[i + 4 : i + 4 + on] == words.hashes[j + 4 : j + 4 + on]
        assert equal[0].sum() <= m <= far and equal[1].sum() <= n <= 20


def test_passages_of_missing_and_repeated_ids_and_of_very_long_texts(documents_from):
    common = passage(3, 70)
    long = " ".join(passage(20 + i, 400) for i in range(60))
    texts = [f"{common} {passage(10, 30)}", f"{long} {common}", f"{passage(11, 30)} {common}", common, f"{common} {passage(12, 9)}"]
    # The third and the fourth are one document, the last has no id.
    ids = "CASE WHEN doc_id = 3 THEN 2 WHEN doc_id < 4 THEN doc_id END AS doc_id"
    frame = documents_from(texts).selectExpr(ids, "text", "score")
    for shard_bytes in (500, 1 << 20):
        found = chaining.shared_passages(frame, shard_bytes).collect()
        assert {(row["doc_id"], row["ref_id"]) for row in found} == {(1, 0), (2, 0)}
        at = [row for row in found if row["doc_id"] == 1]
        assert [(row["begin"], row["end"], row["matched"]) for row in at] == [(24_000, 24_070, 70)]


def changed(words, share, every, draw):
    places = range(every - 1, len(words), every) if every else draw.sample(range(len(words)), round(len(words) * share))
    return [f"new{draw.random()}" if i in set(places) else word for i, word in enumerate(words)]


def test_changed_passages_are_found_in_unrelated_surroundings(documents_from):
    draw = random.Random(11)

    def fresh(size):
        return [f"{draw.choice('abcdefgh')}{draw.randrange(10**9)}" for _ in range(size)]

    cases = [(45, 0, 0), (50, 0.05, 0), (50, 0.1, 0), (50, 0.15, 0), (100, 0.1, 0), (100, 0.15, 0), (50, 0, 10), (100, 0, 7)]
    pairs, texts = 60, []
    for size, share, every in cases:
        for _ in range(pairs):
            words = fresh(size)
            texts += [" ".join(fresh(60) + w + fresh(60)) for w in (words, changed(words, share, every, draw))]
    found = chaining.shared_passages(documents_from(texts), 200_000).collect()
    assert all(row["ref_id"] == row["doc_id"] - 1 and row["doc_id"] % 2 for row in found)
    docs = {row["doc_id"] for row in found}
    for number, case in enumerate(cases):
        inside = {doc for doc in docs if doc // (2 * pairs) == number}
        assert len(inside) >= 0.9 * pairs, case
        # What is found covers the passage but for a few words at its ends.
        rows = [row for row in found if row["doc_id"] in inside]
        assert all(row["begin"] >= 50 and row["end"] <= 70 + case[0] and row["identity"] >= 0.8 for row in rows)


def test_a_run_of_seeds_chains_as_its_seeds_do():
    x = np.array([0, 5, 11, 40, 46, 20])
    y = np.array([3, 8, 14, 50, 56, 2])
    seeds = chaining.best_chains(x, y)[0]
    runs = chaining.best_chains(np.array([0, 40, 20]), np.array([3, 50, 2]), np.array([11, 6, 0]))[0]
    assert seeds == [0, 1, 2, 3, 4] and runs == [0, 1]


def test_many_runs_are_aligned_as_one():
    draw = random.Random(3)
    rows = []
    for _ in range(200):
        size, x, room = draw.randint(1, 6), draw.randint(0, 20), draw.randint(0, 20)
        own = np.array([draw.randrange(50) for _ in range(x + size + room)], np.uint32)
        other = np.where([draw.random() < 0.8 for _ in own], own, 99).astype(np.uint32)[draw.randint(0, x) :]
        y = x - (len(own) - len(other))
        rows.append((own, other, x, y, size))
    own, other = (pa.array([row[i].tobytes() for row in rows], pa.binary()) for i in (0, 1))
    x, y, sizes = (np.array([row[i] for row in rows]) for i in (2, 3, 4))
    many = np.array(chaining.align_runs(own, other, x, y, sizes)).T.tolist()
    each = [chaining.align(a, b, *(np.array([n]) for n in numbers)) for a, b, *numbers in rows]
    assert many == [list(row) for row in each]


@pytest.mark.parametrize("seed", range(6))
def test_chains_are_the_best(seed):
    draw = random.Random(seed)
    points = sorted({(draw.randrange(60), draw.randrange(60)) for _ in range(9)})
    x, y = (np.array([p[i] for p in points]) for i in (0, 1))
    best = {}

    def score(i):
        if i not in best:
            before = [score(j) - (x[i] - x[j] + y[i] - y[j]) / chaining.GAP_WORDS for j in range(len(x)) if x[j] < x[i] and y[j] < y[i]]
            best[i] = chaining.K + max([0, *before])
        return best[i]

    chain = chaining.best_chains(x, y)[0]
    value = sum(chaining.K for _ in chain) - sum(
        (x[b] - x[a] + y[b] - y[a]) / chaining.GAP_WORDS for a, b in zip(chain, chain[1:])
    )
    assert value == pytest.approx(max(score(i) for i in range(len(x))))
    assert sorted(i for c in chaining.best_chains(x, y) for i in c) == list(range(len(x)))

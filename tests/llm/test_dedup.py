import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from textloom.llm import common, embedding_join, minhash, queries, suffix_dedup


def groups_of(edges, nodes):
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(12)]
    got = common.connected_components(spark.createDataFrame(edges, "src long, dst long"))
    assert {r["node"]: r["component"] for r in got.collect()} == groups_of(edges, {n for e in edges for n in e})


def test_components_of_nothing(spark):
    assert common.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


# ------------------------------------------------------------ repeated passages


def brute_repeats(texts, size=suffix_dedup.LENGTH):
    seen = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        rest = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out


def passages(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(rng.randrange(20, 90)) for _ in range(6)]
    docs = [None, "", "short", "x" * 700, "ab" * 300, text(80)]
    for _ in range(40):
        docs.append(text(rng.randrange(5, 60)).join(rng.choice([*shared, text(9)]) for _ in range(rng.randrange(1, 5))))
    docs += [docs[10], docs[10], docs[12][3:], docs[13][:-2] + "zz", shared[0] * 3]
    line = text(20)[:120]
    return docs + [text(12) + line + text(12) for _ in range(15)]


@pytest.mark.parametrize("limit", [5000, 3, 1])
def test_repeats_are_those_of_all_pairs(spark, monkeypatch, limit):
    monkeypatch.setattr(suffix_dedup, "BUCKET_LIMIT", limit)
    texts = passages(limit)
    rows = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, spans string, rid int").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(rows).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats([(t or "").encode() for t in texts])


def test_a_line_in_every_document(spark):
    """One lead with 20,000 different surroundings, some of which are the same again."""
    rng = random.Random(4)
    line = "".join(rng.choice("abcdefgh ") for _ in range(150))
    around = lambda: "".join(rng.choice("xyzuvw ") for _ in range(120))
    sides = [around() for _ in range(40)]
    texts = [around() + line + around() for _ in range(20_000)]
    for k in range(0, 4000, 100):  # the same before the line, or the same behind it
        texts[k] = (sides[k // 100] + line + around()) if k % 200 else (around() + line + sides[k // 100])
        texts[k + 1] = (sides[k // 100] + line + around()) if k % 200 else (around() + line + sides[k // 100])
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(rows).collect()}
    seen = Counter(hash(t[i : i + 200]) for t in texts for i in range(len(t) - 199))
    want = 0
    for k, t in enumerate(texts):
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if seen[hash(t[i : i + 200])] > 1:
                gone[i : i + 200] = b"\1" * 200
        want += sum(gone) > 0
        assert got[k][1] == sum(gone)
    assert want >= 80


def test_small_runs_of_leads_change_nothing():
    texts = [(t or "").encode() for t in passages(11)]
    at, lo, hi, owner, lead = suffix_dedup.anchors(texts)
    whole, starts = b"".join(texts), np.cumsum([0, *map(len, texts)])
    covered = [[] for _ in texts]
    for value in set(lead.tolist()):
        k = np.flatnonzero(lead == value)
        bodies = [whole[lo[i] : hi[i] + suffix_dedup.LENGTH] for i in k]
        rows, low, high = suffix_dedup.repeated_spans(at[k] - lo[k], hi[k] - lo[k] + 1, bodies)
        for r, a, b in zip(rows, low, high):
            i = k[r]
            covered[owner[i]].append((at[i] - b - starts[owner[i]], at[i] - a + suffix_dedup.LENGTH - starts[owner[i]]))
    got = [sum(b - a for a, b in suffix_dedup.merge_spans(c)) for c in covered]
    assert got == [n for _, n, _, _ in brute_repeats(texts)]


def test_multikey_order_sorts():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 3, (200, 24)).astype(np.uint8)
    rows[50:90] = rows[10]
    order = suffix_dedup.multikey_order(rows)
    ranked = [rows[i].tobytes() for i in order]
    assert ranked == sorted(ranked)
    assert suffix_dedup.common_prefixes(rows, order)[0] == -1


def test_repeats_of_odd_rows(spark):
    rows = spark.createDataFrame([(1, None), (None, "y" * 250), (None, "y" * 250), (2, "abc" * 70)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in suffix_dedup.remove_repeats(rows).collect())
    assert got == [(0, 250, 250), (0, 250, 250), (1, 0, 0), (2, 210, 210)]
    assert suffix_dedup.remove_repeats(rows.limit(0)).count() == 0


# ------------------------------------------------------------ embeddings


def test_links_are_those_of_all_pairs(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8))
    x = np.concatenate([c + 0.1 * rng.normal(size=(25, 8)) for c in centres]).astype(np.float32)
    vectors = [(i, v.tolist()) for i, v in enumerate(x)]
    vectors += [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [None] * 8), (904, [1.0]), (905, x[3].tolist()), (None, x[3].tolist())]
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_join.embedding_groups(rows, block=64).collect() if r["vec_id"] is not None}
    sound = [(i, np.array(v, float)) for i, v in vectors if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)]
    edges = [(i, j) for a, (i, u) in enumerate(sound) for j, v in sound[a + 1 :] if u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.95]
    links = Counter(n for e in edges for n in e)
    part = groups_of(edges, [i for i, _ in vectors if i is not None])
    assert got == {i: (links[i], part[i], part[i] == i) for i in part}


def brute_groups(rows):
    """(vec_id, n_links, component_id) of every row, rows being vectors of their own whatever their ids."""
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = x @ x.T >= 0.95
    np.fill_diagonal(hit, False)
    part = groups_of([(int(a), int(b)) for a, b in zip(*np.nonzero(hit)) if a < b], range(len(rows)))
    least = {}
    for k, root in part.items():
        least[root] = min(least.get(root, rows[k][0]), rows[k][0])
    return sorted((i, int(hit[k].sum()), least[part[k]]) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("block", [16, 8192])
def test_rows_that_repeat_a_vec_id_are_apart(spark, block):
    """Different vectors under one id, among them two that are orthogonal and have links of their own."""
    rng = np.random.default_rng(12)
    centres = np.eye(6) * 3
    rows = [(int(rng.integers(0, 40)), (centres[k % 6] + 0.2 * rng.normal(size=6)).astype(np.float32).tolist()) for k in range(120)]
    rows += [(i, [*map(float, v), 0.0, 0.0, 0.0]) for i, v in ((5, (1, 0, 0)), (5, (0, 1, 0)), (2, (1, 0.01, 0)), (9, (0, 1, 0.01)), (5, (1, 0, 0)))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_join.embedding_groups(frame, block=block).collect())
    assert got == brute_groups(rows)


def test_the_query_has_several_cells(spark, monkeypatch):
    made = []
    cells = embedding_join.Cells
    monkeypatch.setattr(embedding_join, "Cells", lambda pivots, radius: made.append(len(pivots)) or cells(pivots, radius))
    path = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in queries.op5_embedding_groups(spark, path).collect())
    assert got == brute_groups(rows) and made == [embedding_join.LEAST_PIVOTS]


def test_links_of_doubles_and_of_all_lengths(spark):
    big, small = [1e300, 2e300, 0.0], [1e-60, 2e-60, 1e-90]
    vectors = [(1, big), (2, [v / 3 for v in big]), (3, small), (4, [1.0, 0.0, 0.0]), (5, [1.0, 0.0]), (6, [2.0, 0.1]), (7, [0.0, 1.0]), (8, [7.0]), (9, [3.0]), (10, [-3.0])]
    rows = spark.createDataFrame([(i, v, 0, 0) for i, v in vectors], "vec_id long, embedding array<double>, cell int, rep int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_join.embedding_groups(rows, block=1).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (1, 5), 6: (1, 5), 7: (0, 7), 8: (1, 8), 9: (1, 8), 10: (0, 10)}


def test_tight_cells_have_few_guests():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 32))
    x = np.repeat(centres, 50, 0) + 0.02 * rng.normal(size=(2000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cells = embedding_join.Cells(x[::50], float(np.sqrt(0.1)))
    d = cells.distances(x)
    home = cells.home(d)
    for q in range(40):
        cells.low[q], cells.high[q], cells.extent[q] = d[home == q].min(0), d[home == q].max(0), d[home == q, q].max()
    row, cell = cells.guests(d, home)
    near = np.argwhere(np.triu(x @ x.T >= 0.95, 1))
    met = set(zip(row.tolist(), cell.tolist()))
    assert all(home[a] == home[b] or (a, home[b]) in met or (b, home[a]) in met for a, b in near)
    assert len(row) < 2000  # of 39,000 with every cell in reach


def test_embeddings_of_an_empty_table(spark):
    assert embedding_join.embedding_groups(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# ------------------------------------------------------------ near duplicates


def brute_near(texts, weights):
    words = {i: (t or "").split() for i, t in texts.items()}
    sets = {i: (h := minhash.shingles(w))[:1] + (weights(*h),) for i, w in words.items()}
    edges = []
    keys = sorted(texts)
    for k, a in enumerate(keys):
        for b in keys[k + 1 :]:
            if words[a] and (words[a] == words[b] or minhash.weighted_jaccard(sets[a], sets[b]) >= minhash.SIMILARITY):
                edges.append((a, b))
    return groups_of(edges, keys)


@pytest.mark.parametrize("leaders, edits, block", [(3, 3, 1024), (1, 5, 4)])
def test_near_groups(spark, monkeypatch, leaders, edits, block):
    monkeypatch.setattr(minhash, "LEADERS", leaders)
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [[word() for _ in range(rng.randrange(60, 200))] for _ in range(20)]
    texts, n = {}, 0
    for b in base:
        for _ in range(rng.randrange(1, 3 * edits)):
            w = list(b)
            for _ in range(rng.randrange(0, edits)):
                w[rng.randrange(len(w))] = word()
            texts[n] = " ".join(w)
            n += 1
    texts |= {n: None, n + 1: "", n + 2: "one two", n + 3: "one  two", n + 4: " \n"}
    rows = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, component string").repartition(3)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(rows).collect()}
    assert got == brute_near(texts, minhash.document_weights(rows))


@pytest.mark.parametrize("similarity, edit", [(0.8, 17), (0.7, 28)])
def test_links_between_components_of_one_bucket(spark, similarity, edit):
    """Pairs just above the threshold among many texts that share bands and are no links."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    core, texts = [word() for _ in range(200)], []
    for _ in range(60):
        a = list(core)
        a[10:50] = [word() for _ in range(40)]
        b = list(a)
        at = rng.randrange(60, 160)
        b[at : at + edit] = [word() for _ in range(edit)]
        texts += [" ".join(a), " ".join(b)]
    sets = [minhash.shingles(t.split()) for t in texts]
    values = minhash.Sampler()(np.concatenate([h for h, _ in sets]), np.log(np.concatenate([n for _, n in sets])), np.cumsum([0, *(len(h) for h, _ in sets)])[:-1])
    bands = values.reshape(len(texts), minhash.BANDS, minhash.ROWS)
    share = lambda a, b: (bands[a] == bands[b]).all(1).any()
    edges = [(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if share(a, b) and minhash.weighted_jaccard(sets[a], sets[b]) >= similarity]
    assert 55 <= len(edges) <= 60
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(rows, similarity, weights=minhash.Weights()).collect()}
    assert got == groups_of(edges, range(len(texts)))


def test_recall_on_the_documents(spark):
    """All pairs of sf0.01 that share a shingle, whatever its frequency: those linked at 0.8 are in one class, others are not joined by a pair."""
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text")
    weights = minhash.document_weights(docs)
    sets = {r["doc_id"]: (lambda h, n: (h, weights(h, n)))(*minhash.shingles((r["text"] or "").split())) for r in docs.collect()}
    holders = {}
    for i, (h, _) in sets.items():
        for x in h.tolist():
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for ids in holders.values() for k, a in enumerate(ids) for b in ids[k + 1 :]}
    links = [(a, b) for a, b in pairs if minhash.weighted_jaccard(sets[a], sets[b]) >= minhash.SIMILARITY]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs, weights=weights).collect()}
    found = sum(got[a] == got[b] for a, b in links)
    assert len(links) > 50 and found >= 0.99 * len(links), (found, len(links))
    want = groups_of(links, list(sets))
    assert all(want[i] == want[got[i]] for i in got)


def test_bound_is_never_below_what_is_shared():
    rng = np.random.default_rng(4)
    for _ in range(50):
        h = np.sort(rng.integers(0, 1 << 62, 900, dtype=np.uint64))
        sets = [(h[k], rng.random(int(k.sum())) * 5) for k in (rng.random((2, 900)) < 0.8)]
        cells = [np.bincount((x >> np.uint64(40)).astype(np.int64) % minhash.CELLS, w, minhash.CELLS).astype(np.float32) for x, w in sets]
        _, i, j = np.intersect1d(sets[0][0], sets[1][0], return_indices=True)
        shared = np.minimum(sets[0][1][i], sets[1][1][j]).sum()
        assert minhash.most_shared(cells[0], cells[1][None])[0] * (1 + minhash.SLACK) >= shared


def test_near_groups_of_odd_rows(spark):
    rows = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, None)], "doc_id long, text string")
    got = [(r["doc_id"], r["class_id"], r["kept"]) for r in minhash.near_duplicates(rows).collect()]
    assert sorted(got, key=str) == sorted([(None, 3, False), (3, 3, True), (3, 3, True), (None, None, True)], key=str)
    assert minhash.near_duplicates(rows.limit(0)).count() == 0


def test_samples_agree_as_often_as_the_weighted_similarity():
    rng = np.random.default_rng(9)
    h = np.sort(rng.integers(0, 1 << 62, 300, dtype=np.uint64))
    w = rng.integers(1, 5, 300).astype(float)
    a, b = (h[:260], w[:260]), (h[40:], w[40:])
    got = minhash.Sampler(4000, 1)(np.concatenate([a[0], b[0]]), np.log(np.concatenate([a[1], b[1]])), np.array([0, 260]))
    assert abs((got[0] == got[1]).mean() - minhash.weighted_jaccard(a, b)) < 0.04


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in queries.QUERIES}

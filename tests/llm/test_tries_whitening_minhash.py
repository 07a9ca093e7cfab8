"""op11, op12 and op13 against plain versions, over tables with nulls, ties, repeated rows, clashing columns, and no rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidemark.llm import minhash, prefixtrie, whitening
from tidemark.llm.queries import op11_prefix_trie, op12_whiten_embeddings, op13_minhash_near_dedup


def table(path, name, columns):
    path.mkdir(exist_ok=True)
    pq.write_table(pa.table(columns), path / f"{name}.parquet")
    return str(path)


def conversations_of(rows):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    turns = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        turns[r[0]].append((r[2] or "", r[3] or ""))
    return turns


def plain_trie(rows):
    turns, built = conversations_of(rows), {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = [*turns.get(c - int(np.fmod(c, 5)), [])[:h], *turns[c][h:]]
    members = defaultdict(list)
    for c, own in built.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, cs in members.items():
        own = (len(cs) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += own
    ends = lambda p: hashlib.sha256(",".join(str(c) for c in sorted(c for c in members[p] if len(built[c]) == len(p))).encode()).hexdigest()
    return sorted((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p], ends(p)) for p, cs in members.items())


def trie_rows(df):
    return sorted(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def trie_table(path, rows):
    columns = {"conv_id": pa.int64(), "turn": pa.int64(), "role": pa.string(), "text": pa.string()}
    arrays = {c: pa.array([r[i] for r in rows], k) for i, (c, k) in enumerate(columns.items())}
    return table(path, "conversations", arrays | {x: pa.array([1] * len(rows), pa.int64()) for x in ("node", "part", "pos", "n", "h", "_any")})


def made_conversations(seed, n=160):
    rng, rows = random.Random(seed), []
    openings = [[("system", f"s{k}"), ("user", "hé")] for k in range(3)]
    for c in [*rng.sample(range(400), n), -3, -10]:
        own = [*rng.choice(openings)[: rng.randint(0, 2)], *((rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "ccc", None, ""])) for _ in range(rng.randint(0, 9)))]
        for t, (role, text) in enumerate(own):
            rows.append((c, rng.choice([t, t, t, 0, None]), role, text))
    deep = [(1000, t, "user", f"x{t % 3}") for t in range(900)]
    return rows + deep + [(c, t, "user", f"x{t % 3}") for c in (1001, 1002, 7000) for t in range(300)] + rows[:20] + [(None, 1, "user", "lost")]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie(spark, tmp_path, seed):
    rows = made_conversations(seed)
    assert trie_rows(op11_prefix_trie(spark, trie_table(tmp_path / "a", rows))) == plain_trie(rows)


def test_trie_with_many_equal_conversations_over_many_tasks(spark, tmp_path):
    """Ends that span tasks are hashed in small pieces, in order."""
    rows = [(c * 5, t, "user", "same") for c in range(600) for t in range(9)] + made_conversations(3, 20)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = prefixtrie.numbered_turns(spark.read.parquet(trie_table(tmp_path / "a", rows)))
        found = prefixtrie.prefix_trie(*prefixtrie.rebuilt(df), prefixtrie.TrieSpec(piece=40))
        assert trie_rows(found) == plain_trie(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_trie_without_rows(spark, tmp_path):
    assert trie_rows(op11_prefix_trie(spark, trie_table(tmp_path / "a", []))) == []
    assert trie_rows(op11_prefix_trie(spark, trie_table(tmp_path / "b", [(None, 1, "user", "x")]))) == []


def embeddings(path, ids, vectors):
    n = len(ids)
    return table(path, "embeddings", {"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": pa.array([0] * n, pa.int32()), "x": pa.array(["?"] * n), "part": pa.array([1] * n)})


def made_vectors(seed, n=900, d=7):
    rng = np.random.default_rng(seed)
    rows = (rng.normal(size=(n, d)) * np.arange(1, d + 1) / 4 + 0.3).astype(np.float32)
    rows[: n // 3] = rows[0]
    out = [r.tolist() for r in rows]
    out[5][2], out[6][0], out[7], out[8], out[9] = None, float("nan"), None, [], [1.0]
    out[10][1], out[11][1] = float("inf"), 1e30
    return out


def plain_whitening(vectors, k=4):
    good = [i for i, v in enumerate(vectors) if v is not None and len(v) == 7 and all(c is not None and np.isfinite(c) and abs(c) < 1e10 for c in v)]
    x = np.array([[int(np.floor(256 * float(c))) for c in vectors[i]] for i in good], np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    off = (n * fit - s) / n
    values, comps = np.linalg.eigh(off.T @ off / n)
    values, comps = values[::-1], comps[:, ::-1]
    return good, n, ((n * x - s) ** 2).sum(axis=1), ((n * x - s) / n) @ comps[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def test_whitening(spark, tmp_path):
    vectors = made_vectors(1)
    ids = [*range(500), *range(500), None][: len(vectors)]
    rows = op12_whiten_embeddings(spark, embeddings(tmp_path / "a", ids, vectors)).collect()
    good, n, deviations, white, explained = plain_whitening(vectors)
    assert len(rows) == 4 * len(good) and {r.n for r in rows} == {n} and len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    wanted = defaultdict(list)
    signs = None
    got = defaultdict(list)
    for r in rows:
        got[r.vec_id, r.component].append((r.deviation, r.whitened))
        assert abs(r.explained - explained[r.component - 1]) < 1e-9 * explained[r.component - 1]
    for i, d, w in zip(good, deviations.tolist(), white, strict=True):
        for c in range(4):
            wanted[ids[i], c + 1].append((d, float(w[c])))
    signs = [np.sign(sum(a[1] * b[1] for k in wanted if k[1] == c + 1 for a, b in zip(sorted(got[k], key=lambda x: x[0]), sorted(wanted[k], key=lambda x: x[0]), strict=True))) for c in range(4)]
    for k, own in wanted.items():
        mine = sorted((d, w * signs[k[1] - 1]) for d, w in own)
        for (d, w), (d2, w2) in zip(mine, sorted(got[k]), strict=True):
            assert d == d2 and abs(w - w2) < 1e-8


def test_whitening_merges_many_factors(spark):
    """Many small tasks and blocks give the same components."""
    vectors = [v for v in made_vectors(2, 400) if v and len(v) == 7 and all(c is not None and abs(c) < 1e10 for c in v)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").repartition(23)
    spec = whitening.WhitenSpec(block=16, fan_in=2)
    fit = whitening.fit_list(whitening.whole_vectors(df, spec)).repartition(37)
    model = whitening.train(fit, spec)
    *_, explained = plain_whitening(vectors)
    assert np.allclose(model.values / model.trace, explained, rtol=1e-10) and whitening.identity_error(fit, model, spec) < 1e-9


def test_whitening_without_variance(spark, tmp_path):
    rows = op12_whiten_embeddings(spark, embeddings(tmp_path / "a", [1, 2], [[0.5, 1.0]] * 2)).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in rows) == [(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]
    for name, vectors in (("b", []), ("c", [[]]), ("d", [None])):
        assert op12_whiten_embeddings(spark, embeddings(tmp_path / name, list(range(len(vectors))), vectors)).collect() == []
    line = [[float(k), 2.0 * k, 0.0] for k in range(9)]
    rows = op12_whiten_embeddings(spark, embeddings(tmp_path / "e", list(range(9)), line)).collect()
    assert {r.component for r in rows if r.whitened is not None} == {1} and rows[0].identity_error < 1e-9


def test_deviations_beyond_63_bits():
    model = whitening.Whitening(1 << 40, (0, 0), np.zeros((2, 0)), np.zeros(0), 0.0)
    assert model.deviations(np.array([[0, 1 << 50], [3, 4]])) == [None, None] and replace(model, n=1 << 20).deviations(np.array([[3, 4]])) == [25 << 40]


def plain_sets(texts):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    out = []
    for t in texts:
        w = (t or "").encode().translate(lower).split()
        out.append({tuple(w[i : i + 2]) for i in range(max(1, len(w) - 1))} if w else set())
    return out


def plain_components(ids, sets):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, d in enumerate(ids)]


def made_texts(seed):
    rng = random.Random(seed)
    words = [f"W{k}" for k in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.choice([1, 2, 3, 5, 8, 30, 120, 400]))) for _ in range(90)]
    for t in texts[:40]:
        w = t.split()
        for _ in range(rng.randint(1, 6)):  # chains of copies, each with a few other words
            for _ in range(max(1, len(w) // 60)):
                w = [*w]
                w[rng.randrange(len(w))] = rng.choice(words)
            texts.append("\t".join(w).lower())
    hot = rng.choices(words, k=60)
    texts += [" ".join([*hot, *rng.choices(words, k=3)]) for _ in range(150)] + [" ".join(hot)] * 150
    shared = rng.choices(words, k=70)  # a passage that many share, too little for a link
    texts += [" ".join([*shared, *rng.choices(words, k=rng.choice([15, 25, 40]))]) for _ in range(60)]
    return [*texts, None, None, "", " \n ", "É é", "é É", " ".join(rng.choices(words, k=20_000))]


@pytest.mark.parametrize("seed", [1, 2])
def test_minhash_components(spark, tmp_path, seed):
    texts = made_texts(seed)
    ids = random.Random(seed).sample(range(10_000), len(texts))
    ids[3] = ids[2]
    ids[-1] = ids[50] = ids[-2] = None
    n = len(ids)
    columns = {"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts), "lang": pa.array([None] * n, pa.string()), "key": pa.array([7] * n), "row_key": pa.array([1] * n), "bands": pa.array(["?"] * n), "needed_row": pa.array([2] * n)}
    rows = op13_minhash_near_dedup(spark, table(tmp_path / "a", "documents", columns)).collect()
    order = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=order) == sorted(plain_components(ids, plain_sets(texts)), key=order)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_minhash_without_rows(spark, tmp_path):
    schema = {"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())}
    assert op13_minhash_near_dedup(spark, table(tmp_path / "a", "documents", schema)).collect() == []
    schema = {"doc_id": pa.array([4, None], pa.int64()), "text": pa.array([None, ""], pa.string())}
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in op13_minhash_near_dedup(spark, table(tmp_path / "b", "documents", schema)).collect()) == [(0, 0, True), (4, 4, True)]


def test_registers_and_estimates():
    spec, rng = minhash.MinHashSpec(), np.random.default_rng(5)
    own = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    least, regs = minhash.least_hashes(own, spec), minhash.registers(own, spec)
    for v, r in zip(least.tolist(), regs.tolist(), strict=True):
        bits = f"{v:032b}"
        zeros = len(bits) - len(bits.lstrip("0"))
        assert r == (zeros << 10 | int((bits[zeros + 1 :] + "0" * 10)[:10], 2))
    # Estimates lie near the likeness, and collisions near their chance, with few mantissa bits.
    few = replace(spec, mantissa_bits=1, bands=400)
    for n, m in ((3000, 3000), (40, 50)):
        a, b = (rng.integers(0, 1 << 63, k).astype(np.uint64) for k in (n, m))
        agree = (minhash.registers(a, few) == minhash.registers(b, few)).mean()
        assert abs(agree - minhash.collision_chance(n, m, 1)) < 0.04
    for share in (0.5, 0.8, 0.9):
        a, b = own, np.concatenate([own[: int(3000 * 2 * share / (1 + share))], rng.integers(0, 1 << 63, 3000 - int(3000 * 2 * share / (1 + share))).astype(np.uint64)])
        agree = np.array([(minhash.registers(a, spec) == minhash.registers(b, spec)).sum()])
        assert abs(minhash.estimated_likeness(agree, [3000], [3000], spec)[0] - share) < 5 * (share * (1 - share) / spec.registers) ** 0.5

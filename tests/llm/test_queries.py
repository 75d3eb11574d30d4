"""The registered queries against plain versions, over all rows of the smallest tables."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from noticemill.llm import catalog
from noticemill.llm.lm_scoring import Trie, gram_keys, mask
from noticemill.llm.near_dedup import super_minhash
from noticemill.llm.packing import SETTINGS, plan_packing
from noticemill.llm.repeats import column_wise

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in catalog.table(spark, SF, "documents").collect()}


def held(doc_id, mod, at):
    return zlib.crc32(str(doc_id).encode()) % mod == at


def test_sql_queries(spark):
    from oracle_check import compare, duck

    for name, sql in catalog.oracle_sql().items():
        assert compare(spark, duck(SF), catalog.queries()[name], sql, SF) is None, name


def test_packing(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = catalog.op1_best_fit_packing(spark, SF).toPandas()
    by_doc, room = dict(list(found.groupby("doc_id"))), defaultdict(int)
    for doc_id, text in texts.items():
        ids, at = np.array([*tokens.encode(text, add_special_tokens=False).ids, 0], "<u4"), 0
        for k, r in enumerate(by_doc[doc_id].sort_values("piece").itertuples()):
            assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(ids[at:at + r.length].tobytes()))
            assert r.length == 2048 or k == 0
            at += r.length
        assert at == len(ids)
    for r in found.sort_values(["sequence_id", "offset"]).itertuples():
        assert r.offset == room[r.sequence_id]
        room[r.sequence_id] += r.length
    assert max(room.values()) <= 2048 and len(room) <= 1.02 * found["length"].sum() / 2048 + 1


@pytest.mark.parametrize("groups, large", SETTINGS)
def test_plan_uses_every_piece_once(groups, large):
    random = np.random.default_rng(5)
    histogram = {int(s): int(n) for s, n in zip(range(1, 2049), random.integers(0, 40, 2048))}
    plan, held_, ends = plan_packing(histogram, 2048, groups, large), defaultdict(int), defaultdict(list)
    for size, first, n, sequence, offset in plan:
        assert first == held_[size]
        held_[size] += n
        for s in range(sequence, sequence + n):
            ends[s].append((offset, offset + size))
    assert held_ == {s: n for s, n in histogram.items() if n}
    for runs in ends.values():
        runs.sort()
        assert runs[0][0] == 0 and all(a[1] == b[0] for a, b in zip(runs, runs[1:])) and runs[-1][1] <= 2048


def test_toxicity_held_out(spark):
    sf = SF.replace("0.001", "0.1")
    found = catalog.op2_toxicity(spark, sf).filter("held_out").join(catalog.table(spark, sf, "labels"), "doc_id").toPandas()
    hit = ((found.predicted == 1) & (found.toxic == 1)).sum()
    assert hit >= 0.9 * (found.toxic == 1).sum() and hit >= 0.95 * (found.predicted == 1).sum()


def test_language_held_out(spark):
    found = catalog.op6_language_id(spark, SF).filter("held_out").join(catalog.table(spark, SF, "documents"), "doc_id").toPandas()
    assert (found.lang_pred == found.lang).mean() > 0.97


def test_word_scores(spark, texts):
    found = {r["doc_id"]: r for r in catalog.op3_ppm_score(spark, SF).collect()}
    words = {i: t.encode().lower().split() for i, t in texts.items()}
    counts = Counter(w for i, ws in words.items() if not held(i, 7, 2) for w in [*ws, None])
    total, kinds = sum(counts.values()), len(counts)
    for i, ws in words.items():
        r, c = found[i], [counts[w] for w in [*ws, None]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(c), sum(x > 0 for x in c), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((x + 1) / (total + kinds + 1)) for x in c))


def test_ppm_is_a_distribution_and_matches_a_plain_one():
    texts, order = [b"abracadabra", b"abrab", b"", b"cadab" * 3], 3
    keys = gram_keys(texts, order)[0]
    trie = Trie([np.unique(keys & mask(k + 1), return_counts=True) for k in range(order + 1)])
    counts = defaultdict(Counter)
    for t in texts:
        s = [257] * order + [*t, 256]
        for i in range(order, len(s)):
            for k in range(order + 1):
                counts[tuple(s[i - k:i])][s[i]] += 1

    def probability(context, symbol):
        excluded, p = set(), 1.0
        for k in range(order, -1, -1):
            here = {a: n for a, n in counts.get(tuple(context[order - k:]), {}).items() if a not in excluded}
            if here:
                if symbol in here:
                    return p * (here[symbol] - 0.5) / sum(here.values())
                p *= 0.5 * len(here) / sum(here.values())
                excluded |= set(here)
        return p / (257 - len(excluded))

    assert sum(probability([98, 114, 97], a) for a in range(257)) == pytest.approx(1)
    for t in (b"abra", b"zzz", b"cadabrac", b""):
        s = [257] * order + [*t, 256]
        plain = sum(math.log10(probability(s[i - order:i], s[i])) for i in range(order, len(s)))
        assert trie.score([t])[0] == pytest.approx(plain)


def test_repeated_strings(spark, texts):
    found, seen = {r["doc_id"]: r for r in catalog.op4_repeated_strings(spark, SF).collect()}, set()
    for i in sorted(texts):
        data = texts[i].encode()
        gone = np.zeros(len(data) + 1, np.int8)
        for k in range(len(data) - 99):
            if data[k:k + 100] in seen:
                gone[k:k + 100] = 1
            seen.add(data[k:k + 100])
        kept = np.frombuffer(data, np.uint8)[gone[:-1] == 0].tobytes()
        r = found[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (
            len(data), gone.sum(), (np.diff(gone, prepend=0) == 1).sum(), hashlib.sha256(kept).hexdigest())


def test_column_wise_order_matches_sorted_suffixes():
    random = np.random.default_rng(2)
    for _ in range(60):
        texts = [bytes(random.choice([0, 97, 98, 255], random.integers(1, 25)).astype(np.uint8)) for _ in range(random.integers(1, 8))]
        suffixes = sorted((t[o:], j) for j, t in enumerate(texts) for o in range(len(t) + 1))
        common = [0]
        for (a, _), (b, _) in zip(suffixes, suffixes[1:]):
            common.append(next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))))
        assert column_wise(texts, 5)[1].tolist() == [min(5, c) for c in common]


def test_mixing_meets_targets(spark, texts):
    found = catalog.op5_source_mix(spark, SF).join(catalog.table(spark, SF, "documents").select("doc_id", "source"), "doc_id").toPandas()
    sizes = {i: len(t.encode().split()) for i, t in texts.items()}
    assert dict(zip(found.doc_id, found["size"])) == sizes and (found.taken <= 2 * found["size"]).all()
    by_source = found.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum")).sort_index()
    weight = dict(zip(sorted(by_source.index), [3, 1, 2] * len(by_source)))
    open_, target = set(by_source.index), {}
    while True:
        left = 1.5 * sum(sizes.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * by_source["size"][s]}
        if not over:
            break
        target |= {s: 2.0 * by_source["size"][s] for s in over}
        open_ -= over
    target |= share
    for s, r in by_source.iterrows():
        assert r.target == pytest.approx(target[s]) and abs(r.taken - r.target) <= max(50, 0.02 * r.target)


def test_near_groups(spark, texts):
    found = {r["doc_id"]: r for r in catalog.op8_near_dedup(spark, SF).collect()}
    sets = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    group = {i: i for i in texts}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in sorted(texts):
        for j in sorted(texts):
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                group[b] = a
    for i in texts:
        assert (found[i]["n_shingles"], found[i]["component_id"], found[i]["kept"]) == (len(sets[i]), root(i), root(i) == i)


def test_super_minhash_estimates_similarity():
    random = np.random.default_rng(3)
    a, b = random.integers(0, 1 << 62, (2, 400)).astype(np.uint64)
    b[:300] = a[:300]
    with np.errstate(over="ignore"):
        x, y = super_minhash([np.unique(a), np.unique(b)], 1024)
    assert abs((x == y).mean() - 300 / 500) < 0.05


def test_neighbours_recall(spark):
    for sf in (SF, SF.replace("0.001", "0.1")):
        rows = catalog.table(spark, sf, "embeddings").toPandas()
        ids, x = rows.vec_id.to_numpy(), np.stack(rows.embedding).astype(float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        found, hits, total = dict(list(catalog.op10_nearest_neighbours(spark, sf).toPandas().groupby("query_id"))), 0, 0
        for q in np.flatnonzero(ids % 50 == 0):
            near = x @ x[q]
            near[q] = -2
            best = ids[np.lexsort((ids, -near))[:5]]
            got = found[ids[q]].sort_values("rank")
            assert got["rank"].tolist() == [1, 2, 3, 4, 5]
            assert np.allclose(got.score, [near[ids == v][0] for v in got.vec_id])
            hits, total = hits + len({*best} & {*got.vec_id}), total + 5
        assert hits >= 0.9 * total


def test_pipeline(spark, texts):
    import corpus_pipeline

    docs = catalog.table(spark, SF, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        assert docs.columns == columns
        kept[name] = [r["doc_id"] for r in docs.select("doc_id").collect()]
    scores = catalog.score(catalog.table(spark, SF, "documents"), catalog.toxicity_model(spark, catalog.table(spark, SF, "documents"), SF))
    assert set(kept["toxicity"]) == {r["doc_id"] for r in scores.filter("score < 0.5").collect()}
    last = {texts[i]: i for i in sorted(kept["toxicity"])}
    assert sorted(kept["exact_dedup"]) == sorted(last.values())
    assert set(kept["near_dedup"]) <= set(kept["exact_dedup"])
    assert max(Counter(kept["source_mix"]).values()) <= 2 and set(kept["source_mix"]) <= set(kept["near_dedup"])
    packed = Counter(r["doc_id"] for r in corpus_pipeline.run(spark, SF).filter("piece = 0").collect())
    assert packed == Counter(kept["source_mix"])


def test_pipeline_stages_match_plain_versions(spark, texts):
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    docs, kept = catalog.table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        kept[name] = [(r["doc_id"], r["source"]) for r in docs.select("doc_id", "source").collect()]

    inputs = sorted(i for i, _ in kept["exact_dedup"])
    sets, group = {}, {i: i for i in inputs}
    for i in inputs:
        w = texts[i].encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in inputs:
        for j in inputs:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                group[b] = a
    assert sorted(i for i, _ in kept["near_dedup"]) == [i for i in inputs if root(i) == i]

    size, taken = Counter(), Counter()
    for i, source in kept["near_dedup"]:
        size[source] += len(texts[i].encode().split())
    for i, source in kept["source_mix"]:
        taken[source] += len(texts[i].encode().split())
    weight, open_, target = dict(zip(sorted(size), [3, 1, 2] * len(size))), set(size), {}
    while True:
        left = 1.5 * sum(size.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * size[s]}
        if not over:
            break
        target |= {s: 2.0 * size[s] for s in over}
        open_ -= over
    target |= share
    for s in size:
        assert abs(taken[s] - target[s]) <= max(50, 0.02 * target[s])

    tokens, plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter()
    for i, _ in kept["source_mix"]:
        ids = np.array([*tokens.encode(texts[i], add_special_tokens=False).ids, 0], "<u4")
        ends = range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)  # the first piece is the short one
        plain.update((i, k, zlib.crc32(ids[max(0, end - 2048):end].tobytes())) for k, end in enumerate(ends))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).select("doc_id", "piece", "ids_crc32").collect()
    assert Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed) == plain

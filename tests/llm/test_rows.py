"""Odd rows through every operator: nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from noticemill.llm import chat, exact_dedup, language_id, lm_scoring, mixing, near_dedup, neighbours, packing, repeats, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, row string, key string, n int, copies int"
LONG = " ".join(f"word{i % 977} plain" for i in range(20_000))
SHARED = "one shared passage that is well over a hundred bytes long and stands in two of the documents of this table, word by word."


def rows(spark, empty=False):
    data = [
        (1, "The red fox jumps over the lazy dog today", "en", "a"), (2, "The red fox jumps over the lazy dog today", "en", "b"),
        (3, None, None, None), (4, "", "en", "a"), (5, " \t\n ", None, "b"), (6, LONG, "en", "a"), (7, LONG + " end", "en", None),
        (8, "idiot", "de", "a"), (9, "Überall größere Straßen 你好 \U0001f600", "de", "b"), (9, "Überall größere Straßen 你好 \U0001f600", "de", "b"),
        (None, "no id here", "en", "a"), (11, "Start. " + SHARED, "en", "c"), (12, SHARED + " And more.", "en", "c"), (13, "a" * 500, None, "c"),
    ]
    data = [] if empty else [(*r, "x", "y", 1, 2) for r in data]
    return spark.createDataFrame(data, SCHEMA)


def ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=lambda i: (i is None, i))


@pytest.fixture(scope="module")
def docs(spark):
    return rows(spark).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return rows(spark, empty=True)


ALL = [1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 11, 12, 13, None]


def test_packing(docs, none):
    out = packing.pack_documents(docs, capacity=64, keep_ids=True).collect()
    assert sorted({r["doc_id"] for r in out}, key=lambda i: (i is None, i)) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 12, 13, None]
    assert {(r["length"], tuple(r["ids"])) for r in out if r["doc_id"] in (3, 4)} == {(1, (0,))}
    assert sum(r["doc_id"] == 9 and r["piece"] == 0 for r in out) == 2
    room = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == room.get(r["sequence_id"], 0)
        room[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(room.values()) <= 64
    assert packing.pack_documents(none).count() == 0


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(i, 1 if i == 8 else 0) for i in (1, 2, 4, 6, 8)] + [(3, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    scored = toxicity.score(docs, model).collect()
    assert len(scored) == 14 and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    blank = toxicity.learn(none, labels.limit(0))
    assert toxicity.score(none, blank).count() == 0


def test_toxicity_scores_terms_by_their_clause():
    model = toxicity.Model({"idiot": 3.0, "moron": 2.5}, [-1.0, 0.0, 0.0, 0.0, 2.0, 2.0])
    aimed = "Look, you idiot. Then a moron came."
    denied = "He is not an idiot. Never a moron at all."
    quoted = "They said the idiot came. She wrote of a moron."
    assert model.features(aimed)[3:] == pytest.approx((np.log(3), np.log(3)))
    assert model.features(denied)[3:] == pytest.approx((np.log(1.6), np.log(1.6)))
    assert model.features(quoted)[3:] == pytest.approx((np.log(2.2), np.log(2.2)))
    assert model.features("Not an idiot. You idiot! He said idiot.")[3:] == pytest.approx((np.log(2), np.log(2.9)))
    assert model.score(denied) < model.score(quoted) < model.score(aimed)


def plain_clauses(model, text):
    """Sum, peak, and per term the shares of its occurrences, by looking back from each word instead of running states."""
    sums, shares = [], {}
    for clause in toxicity.CLAUSE.findall(text.lower()):
        own = toxicity.TOKEN.findall(clause)
        kinds, total = [model.kind(w) for w in own], 0.0
        for i, (word, kind) in enumerate(zip(own, kinds)):
            if kind not in "IT":
                continue
            near = kinds[max(0, i - 3):i]
            mark = ("q" if "R" in kinds[:i] else "") + ("d" if "N" in near else "")
            factor = {"": 1.0, "d": 0.3, "q": 0.6, "qd": 0.2}[mark]
            if kind == "I":
                shares.setdefault(word, []).append(factor)
            if kind == "I" or "G" in near:
                total += (model.weight(word) if kind == "I" else model.threat) * factor * (model.aimed if "G" in near else 1.0)
        sums.append(total)
    return sum(sums), max(sums, default=0.0), shares


def test_toxicity_grammar_matches_a_plain_scorer():
    random = np.random.default_rng(9)
    model = toxicity.Model({"idiot": 3.0, "moro*": 2.5, "fool": 1.0})
    vocabulary = "idiot moron fool kill burn you your they not never said wrote the red fox. jumps; over, lazy!".split()
    for _ in range(400):
        text = " ".join(random.choice(vocabulary, random.integers(0, 40)))
        words = toxicity.TOKEN.findall(text.lower())
        total, peak, shares = plain_clauses(model, text)
        wanted = (total, peak, 1000 * total / max(1, len(words)), sum(max(v) for v in shares.values()), sum(sum(v) for v in shares.values()))
        assert model.features(text) == pytest.approx([np.log1p(x) for x in wanted])


def test_toxicity_composition_runs_like_its_parts():
    random = np.random.default_rng(4)
    for _ in range(300):
        symbols = random.choice(list(toxicity.ALPHABET), random.integers(0, 30)).tolist()
        plain = symbols
        for part in (toxicity.negation(), toxicity.reported(), toxicity.aimed()):
            plain = part.run(plain)
        assert toxicity.GRAMMAR.run(symbols) == plain


def test_toxicity_learns_alike_from_any_layout(spark):
    toxic = [f"You are {w} {x} and the town knows it" for x in ("a fool", "an idiot") for w in ("such", "quite", "truly", "still", "always", "surely")]
    clean = [f"The river {i} runs past mill {i % 7} and the town knows it" for i in range(60)]
    data = [(i, toxic[i % 12] if i < 60 else clean[i % 60]) for i in range(360)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i, _ in data], "doc_id long, toxic int")
    once = toxicity.learn(docs.coalesce(1), labels)
    assert {"fool", "idiot"} <= {w.rstrip("*") for w in once.insults}
    for again in (toxicity.learn(docs.repartition(8), labels), toxicity.learn(docs.orderBy(F.desc("doc_id")), labels.repartition(5))):
        assert again.insults == once.insults and again.coefficients == once.coefficients


def test_language_model(docs, none):
    out = lm_scoring.score_texts(docs, F.col("doc_id") == 7, order=3, chunk_bytes=20_000).collect()
    by_id = {r["doc_id"]: r for r in out}
    assert len(out) == 14 and by_id[3]["n_tokens"] == by_id[4]["n_tokens"] == by_id[5]["n_tokens"] == 1
    assert by_id[3]["score"] == by_id[4]["score"] < 0 and by_id[7]["held_out"] and not by_id[None]["held_out"]
    assert by_id[7]["n_known"] < by_id[7]["n_tokens"] + 1
    assert lm_scoring.score_texts(none, F.lit(False)).count() == 0


def test_language_model_keeps_every_gram(spark):
    random = np.random.default_rng(3)
    texts = [random.choice(np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8), 60_000).tobytes() for _ in range(24)]
    texts += [texts[3][100:900], texts[5][7:50] + "\u00e9 unseen".encode() + texts[9][:70], b"", b"0123456789"]
    rows = [(i, t.decode(), i >= 24) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held boolean")
    keys = lm_scoring.gram_keys(texts[:24], 5)[0]
    trie = lm_scoring.Trie([np.unique(keys & lm_scoring.mask(k + 1), return_counts=True) for k in range(6)])
    assert len(trie.grams[5][0]) > 1_000_000
    expected = trie.score(texts)
    found = lm_scoring.score_texts(df, F.col("held"), chunk_bytes=300_000, bucket_bytes=400_000).collect()
    assert len(found) == len(texts)
    for r in found:
        assert r["score"] == pytest.approx(expected[r["doc_id"]], rel=1e-9)


@pytest.mark.parametrize("order", [0, 1, 2, 4])
def test_language_model_escapes_as_in_memory(spark, order):
    random = np.random.default_rng(5)
    texts = [bytes(random.choice(list(b"abcdefgh "), random.integers(0, 90)).astype(np.uint8)) for _ in range(60)]
    texts += [t[:40] + b"xy" + t[40:] for t in texts[:20]] + [b"", b"zz \xc3\xa9"]
    df = spark.createDataFrame([(i, t.decode(), i >= 50) for i, t in enumerate(texts)], "doc_id long, text string, held boolean").repartition(3)
    keys = lm_scoring.gram_keys(texts[:50], order)[0]
    trie = lm_scoring.Trie([np.unique(keys & lm_scoring.mask(k + 1), return_counts=True) for k in range(order + 1)])
    found = lm_scoring.score_texts(df, F.col("held"), order=order, chunk_bytes=300, bucket_bytes=700)
    expected = trie.score(texts)
    assert {r["doc_id"]: r["score"] for r in found.collect()} == pytest.approx(dict(enumerate(expected)), rel=1e-9)


def test_language_model_moves_blocks(spark):
    """Words and grams travel in blocks, texts without their words: no row a word or a gram of a chunk is shuffled."""
    rows = [(i, " ".join(f"w{i * j}" for j in range(300))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = lm_scoring.score_texts(df, F.col("doc_id") % 5 == 2, order=3, chunk_bytes=5_000, bucket_bytes=20_000)
    plan = plan_of(found)
    assert "Generate" not in plan and "words" not in plan.replace("/words-", "")
    counts = Counter(w for i, t in rows if i % 5 != 2 for w in t.split())
    assert {r["doc_id"]: r["n_known"] for r in found.collect()} == {i: sum(w in counts for w in t.split()) + 1 for i, t in rows}


def test_repeats(docs, none):
    out = {r["doc_id"]: r for r in repeats.remove_repeats(docs).collect()}
    assert out[3]["n_bytes"] == 0 and out[3]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert bytes(out[11]["kept"]).decode() == "Start. " + SHARED and bytes(out[12]["kept"]).decode() == " And more."
    assert (out[13]["n_removed"], out[13]["n_spans"]) == (499, 1)
    assert out[1]["n_removed"] == out[2]["n_removed"] == out[9]["n_removed"] == 0
    assert repeats.remove_repeats(none).count() == 0


def covered_before(rows, length=100):
    """``id, text``: sizes and what is left, by looking at every string; rows that repeat id and text are one document."""
    seen, out = set(), []
    for i, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0])):
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, np.int8)
        for k in range(len(data) - length + 1):
            if data[k:k + length] in seen:
                gone[k:k + length] = 1
            seen.add(data[k:k + length])
        out += [(i, len(data), int(gone.sum()), int((np.diff(gone, prepend=0) == 1).sum()))] * rows.count((i, t))
    return sorted(out, key=str)


def repetitive_rows():
    random = np.random.default_rng(11)
    word = lambda n, letters="abcdefgh ": "".join(random.choice(list(letters), n))
    passages = [word(int(n)) for n in random.integers(60, 400, 12)] + ["ab" * 130, word(35) * 9, "x" * 300, word(99), word(100), "\u00e9\0" * 90]
    texts = ["".join(passages[k][int(a):] + word(int(m)) for k, a, m in zip(
        random.integers(0, len(passages), 5), random.integers(0, 40, 5), random.integers(0, 30, 5))) for _ in range(40)]
    rows = [*enumerate(texts), (100, None), (101, ""), (102, texts[3]), (None, texts[7] + "z" + texts[7]), (5, texts[5])]
    return rows


@pytest.mark.parametrize("hot_pieces, bucket_bytes", [(100_000, 4_000_000), (100_000, 3_000), (3, 20_000), (0, 20_000)])
def test_repeats_by_every_path_match_brute_force(spark, hot_pieces, bucket_bytes):
    rows = repetitive_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = repeats.remove_repeats(df, hot_pieces=hot_pieces, bucket_bytes=bucket_bytes).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in found), key=str) == covered_before(rows)


def test_repeats_send_no_windows_or_spans_through_the_driver(spark):
    """Spark takes the windows cut from a few pieces, and spans, for as small as their files; a broadcast of them would fill the driver."""
    random = np.random.default_rng(12)
    every = [bytes(random.choice(list(b"abcdefgh "), 160).astype(np.uint8)) for _ in range(20)]
    every = [every[i % 20][: 120 + i // 20] for i in range(60)]
    rows = spark.createDataFrame([(i, i * 7, bytearray(x)) for i, x in enumerate(every)], "row_id long, row_hash long, data binary").repartition(3)

    def cut(batch):
        yield None, batch["row_id"].to_numpy(), batch["row_hash"].to_numpy(), np.zeros(len(batch), np.int64), list(batch["data"])

    found = repeats.hot_repeats(rows, cut, 100)
    assert "SortMergeJoin" in plan_of(found) and "Broadcast" not in plan_of(found)
    # No two pieces are equal, so every window of a piece that an earlier one has comes back.
    windows = [(i, i * 7, o, o + 100) for i in range(20, 60) for o in range(len(every[i]) - 99) if any(every[i][o:o + 100] in x for x in every[:i])]
    assert sorted(map(tuple, found.collect())) == sorted(windows)
    docs = spark.createDataFrame(repetitive_rows(), "doc_id long, text string")
    assert "SortMergeJoin" in (plan := plan_of(repeats.remove_repeats(docs, hot_pieces=0))) and "Broadcast" not in plan


def test_repeats_rounds_end_at_the_gram(monkeypatch):
    """The transform gets what stands before the hash of a window alone, in collections of few pieces, and pieces travel in blocks."""
    rounds, texts = [], [t.encode() for _, t in repetitive_rows()[:40]]
    plain = repeats.column_wise

    def watched(parts, length, *common):
        rounds.append((max(map(len, parts)), len(parts)))
        return plain(parts, length, *common)

    monkeypatch.setattr(repeats, "column_wise", watched)
    monkeypatch.setattr(repeats, "COLLECTION", 20)
    found = []
    for gram, number, start, n in repeats.pieces(texts, 100, lambda h, core: np.ones(core.shape, bool)):
        own = [texts[i][a: a + w + 99] for i, a, w in zip(number.tolist(), start.tolist(), n.tolist())]
        found.append((gram, number, np.zeros(len(number), np.int64), start, own))
    blocks = repeats.dealt(found, 3)
    assert len(blocks) <= 3 and len(repeats.repeats_of(blocks, 100)) > 0
    assert max(r[0] for r in rounds) <= 100 - repeats.GRAM and len(rounds) > 5


def test_mixing(docs, none):
    out = mixing.mix(docs).collect()
    assert ids(mixing.mix(docs)) == ALL
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in out)
    assert {r["doc_id"]: r["size"] for r in out}[3] == 0
    assert sorted((r["doc_id"] or 0, r["taken"]) for r in out) == sorted((r["doc_id"] or 0, r["taken"]) for r in mixing.mix(docs.repartition(5)).collect())
    taken = mixing.take(docs)
    assert taken.columns == docs.columns and taken.count() == sum(r["copies"] for r in out)
    assert mixing.mix(none).count() == mixing.take(none).count() == 0


def test_mixing_spreads_repeated_rows(spark):
    from noticemill.llm.common import written

    many = 30_000
    docs = spark.range(many + 6_000).select(
        F.when(F.col("id") < many, 7).otherwise(F.col("id")).cast("long").alias("doc_id"), F.lit("one two three").alias("text"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"))
    one = written(mixing.mix(docs), "mixed")
    totals = {r["source_size"]: (r["taken"], r["target"], r["n"]) for r in one.groupBy("source_size").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.count("*").alias("n")).collect()}
    assert sum(n for _, _, n in totals.values()) == many + 6_000
    by_copies = one.groupBy("doc_id", "row", "copies").count()
    again = mixing.mix(docs.repartition(7)).groupBy("doc_id", "row", "copies").count()
    assert sorted(map(tuple, by_copies.collect())) == sorted(map(tuple, again.collect()))
    mixed = one.agg(F.sum("taken").alias("taken"), F.sum("size").alias("size")).first()
    assert abs(mixed["taken"] - 1.5 * mixed["size"]) <= 12
    taken = mixing.take(docs)
    assert taken.count() == one.agg(F.sum("copies")).first()[0]


def test_mixing_blocks_of_repeated_rows_are_bounded(spark, monkeypatch):
    sizes = spark.sparkContext.accumulator(0)
    largest = 2 * mixing.BLOCK
    real = mixing._fly

    def watched(land, round_no):
        run = real(land, round_no)

        def counted(key, rows):
            if len(rows) > largest:
                sizes.add(1)
            return run(key, rows)

        return counted

    monkeypatch.setattr(mixing, "_fly", watched)
    docs = spark.range(40_000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("one two").alias("text"), F.lit("a").alias("source"))
    assert mixing.mix(docs, weights=(1,), share=0.5).agg(F.sum("taken")).first()[0] == 40_000
    assert sizes.value == 0


def test_language_id(docs, none):
    profiles = language_id.learn_profiles(docs)
    out = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(docs, profiles).collect()}
    assert out[3] == out[4] == out[5] == ("und", 0.0) and out[1][0] == "en" and out[9][0] == "de"
    assert {r["lang_pred"] for r in language_id.identify(docs, language_id.learn_profiles(none)).collect()} == {"und"}
    assert language_id.identify(none, profiles).count() == 0


def test_exact(docs, none):
    out = exact_dedup.exact_groups(docs).collect()
    assert ids(exact_dedup.exact_groups(docs)) == ALL
    by_id = {r["doc_id"]: r for r in out}
    assert (by_id[1]["keep_id"], by_id[1]["group_size"], by_id[1]["kept"], by_id[2]["kept"]) == (2, 2, False, True)
    assert (by_id[3]["keep_id"], by_id[4]["kept"]) == (4, True) and by_id[None]["kept"]
    assert by_id[6]["group_size"] == 1 and by_id[9]["group_size"] == 2
    kept = exact_dedup.drop_copies(docs)
    assert ids(kept) == [2, 4, 5, 6, 7, 8, 9, 11, 12, 13, None] and kept.columns == docs.columns
    assert exact_dedup.exact_groups(none).count() == exact_dedup.drop_copies(none).count() == 0


def test_near(docs, none):
    out = {r["doc_id"]: r for r in near_dedup.near_groups(docs).collect()}
    assert out[2]["component_id"] == 1 and out[7]["component_id"] == 6 and not out[7]["kept"]
    assert all(out[i]["n_shingles"] == 0 and out[i]["kept"] for i in (3, 4, 5)) and out[8]["n_shingles"] == 1
    assert out[None]["component_id"] is None and out[None]["kept"]
    assert ids(near_dedup.keep_one(docs)) == [1, 3, 4, 5, 6, 8, 9, 9, 11, 13, None]
    assert near_dedup.near_groups(none).count() == 0


def test_chat(spark):
    schema = "conv_id long, seq long, kind string, message_id string, role string, text string, pos int"
    log = spark.createDataFrame([
        (1, 0, "message", "u", "user", r"a \l <b> </turn>" + "\n", 0), (1, 1, "message", "a", "assistant", "Hel", 0),
        (1, 2, "delta", "a", None, "lo", 0), (1, 3, "regenerate", "a", None, "Good ", 0), (1, 5, "delta", "a", None, "day", 0),
        (1, 4, "delta", "a", None, "bright ", 0), (1, 6, "edit", "u", None, "b", 0), (1, 7, "message", "d", "user", "gone", 0),
        (1, 8, "delete", "d", None, None, 0), (None, None, None, None, None, None, 0), (2, 0, "delta", None, "assistant", "x", 0),
        (3, 1, "message", None, "a>\nb", "same", 0), (3, 1, "message", None, "a>\nb", "same", 0),
    ], schema)
    back = {r["conv_id"]: r for r in chat.read_back(chat.render(chat.fold_events(log))).collect()}
    assert [tuple(t) for t in back[1]["turns"]] == [("user", "b"), ("assistant", "Good bright day")]
    assert back[1]["loss_text"] == "Good bright day" and back[2]["loss_text"] == "x"
    assert [tuple(t) for t in back[None]["turns"]] == [("", "")]
    assert [tuple(t) for t in back[3]["turns"]] == [("a>\nb", "same")] * 2
    assert chat.render(chat.fold_events(log.limit(0))).count() == 0


def test_neighbours(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.0], [1.0, 0.0], [0.9, 0.1], [0.0, 1.0], None, [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0], []]
    data = [(i, v, 1) for i, v in enumerate(vectors)] + [(1, [1.0, 0.0], 1), (None, [1.0, 1.0], 1)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, id int")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.nearest(df, F.col("vec_id") == 0, k=5).orderBy("rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_neighbours_ties_of_scaled_copies(spark):
    random = np.random.default_rng(11)
    way = random.integers(-50, 50, 16)
    copies = [(i, (way * int(random.integers(1, 1000))).astype(float).tolist()) for i in range(1, 61)]
    others = [(i, random.normal(size=16).tolist()) for i in range(100, 160)]
    df = spark.createDataFrame([(0, (way * 7 + random.integers(-9, 9, 16)).astype(float).tolist()), *copies, *others], "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, F.col("vec_id").isin(0, 3), k=5).orderBy("query_id", "rank").collect()
    assert [r["vec_id"] for r in found if r["query_id"] == 0] == [1, 2, 3, 4, 5]
    assert [r["vec_id"] for r in found if r["query_id"] == 3] == [1, 2, 4, 5, 6]


def test_neighbours_score_the_vectors_as_given(spark):
    """Scores are those of the given vectors bit by bit, and more near-equal candidates than places come to the exact step."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=5) * 10.0 ** rng.integers(-3, 4)]) for i in range(60)]
    base = rng.normal(size=5)
    rows += [(100 + i, [float(x) for x in base + rng.normal(size=5) * 1e-14]) for i in range(40)]
    rows += [(200, [1e200, 1.0, 0.0, 0.0, 0.0]), (201, [1e-200, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = neighbours.nearest(df, F.col("vec_id").isin(0, 7, 100, 200), k=5, visit_share=1.0).collect()

    def dot(a, b):
        total = 0.0
        for x, y in zip(a, b):
            total += x * y
        return total

    def measure(a, b):
        top, under = dot(a, b), (dot(a, a) ** 0.5) * (dot(b, b) ** 0.5)
        return top / under if 1e-150 < under < 1e150 else None

    given = dict(rows)
    for q in (0, 7, 100):
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        exact = {i: measure(given[q], v) for i, v in rows if i not in (q, 200, 201)}
        want = sorted(exact.items(), key=lambda p: (-p[1], p[0]))
        assert all(s == exact[i] for _, i, s in got)
        if q == 100:  # the others are less near than these by far
            assert all(abs(s - w) < 1e-14 for (_, _, s), (_, w) in zip(got, want))
    assert {r["vec_id"]: r["score"] for r in found if r["query_id"] == 200 and r["rank"] == 1} == {201: 1.0}


def test_chat_turns_with_nulls_stay(spark):
    rows = spark.createDataFrame(
        [(1, 1, "user", "a"), (1, 2, None, "b"), (1, 3, "assistant", None), (1, 3, "assistant", "c" * 200_000)], "conv_id int, pos int, role string, text string")
    back = chat.read_back(chat.render(rows)).collect()[0]
    assert [tuple(t) for t in back["turns"]] == [("user", "a"), ("", "b"), ("assistant", ""), ("assistant", "c" * 200_000)]
    assert back["loss_text"] == "c" * 200_000


def test_chat_log_of_drafts_deltas_edits_and_generations(spark):
    from noticemill.llm.catalog import streamed

    rows = [(1, 0, "user", "abc"), (1, 1, "assistant", "x<y"), (1, 1, "assistant", "x<y"), (1, 2, None, None), (None, None, "user", ""), (2, 5, "assistant", "z")]
    log = streamed(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    kinds = {r["kind"]: r["n"] for r in log.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"message": 6, "delta": 12, "regenerate": 3, "edit": 3}
    back = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat.read_back(chat.render(chat.fold_events(log))).collect()}
    assert back == {1: [("user", "abc"), ("assistant", "x<y"), ("assistant", "x<y"), ("", "")], None: [("user", "")], 2: [("assistant", "z")]}

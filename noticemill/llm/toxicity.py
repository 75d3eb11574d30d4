"""Toxicity by a weighted grammar of finite-state transducers.

A text is cut into clauses, a clause into classes of words: insult, threat, target, negation, reported speech and
others. Three transducers are composed into one that runs over the classes: negation marks what it denies, reported
speech what it quotes, then targets strengthen insults and threats near them. The marked clause is
scored, not the word; a document's score is a logistic function of what its clauses add up to.
The insult lexicon and the logistic weights are learned from labelled rows; the closed classes are fixed values.
Equal texts with the same label count once, so what is learned depends neither on how the rows are
dealt over files and tasks nor on how often a text is repeated.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticemill.llm.common import bounded_batches, written

# Closed word classes of the grammar.
NEGATION = "not no never none nor neither cannot n't without kein keine nicht nie ohne ne pas jamais sans nunca sin ningún".split()
REPORTED = ("said says say saying claimed claims called calls quoted quote wrote writes alleged according reported "
            "sagte sagt behauptet schrieb dit disait affirme écrit dijo dice afirma escribió").split()
TARGET = ("you your yours yourself u ur he him she her they them their those these people everyone "
          "du dich dein ihr euch tu toi ton vous votre tú ti usted ustedes ellos").split()
THREAT = ("kill hurt destroy attack beat burn shoot stab murder punish crush töten umbringen schlagen tuer frapper détruire "
          "matar golpear destruir").split()

ALPHABET = "ITGNRO"
INSULT_, THREAT_, TARGET_, NEGATION_, REPORTED_, OTHER = ALPHABET
DENIED, QUOTED, QUOTED_DENIED = "d", "q", "x"  # an insult or threat so marked keeps its weight times these
FACTOR = {DENIED: 0.3, QUOTED: 0.6, QUOTED_DENIED: 0.2}
REACH = 3  # words a negation or a target reaches

CLAUSE = re.compile(r"[^.!?;:\n]+")
TOKEN = re.compile(r"\w+(?:'\w+)?")
STEM = (3, 8)  # lengths of word beginnings that can be lexicon entries
N_FEATURES = 5


@dataclass(frozen=True)
class Transducer:
    """``arcs[state, symbol] = (next state, output)``; an absent symbol follows the state's ``OTHER`` arc unchanged."""

    arcs: dict[tuple[int, str], tuple[int, str]]

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        if (state, symbol) in self.arcs:
            return self.arcs[state, symbol]
        return self.arcs.get((state, OTHER), (state, symbol))[0], symbol

    def run(self, symbols: list[str]) -> list[str]:
        state, out = 0, []
        for s in symbols:
            state, s = self.step(state, s)
            out.append(s)
        return out

    def then(self, other: Transducer) -> Transducer:
        """The composition: one machine that does what running this one and then ``other`` does, over the classes of words.

        Its states are the pairs that can be reached, numbered as they are met.
        """
        number, arcs = {(0, 0): 0}, {}
        waiting = [(0, 0)]
        while waiting:
            pair = waiting.pop()
            for symbol in ALPHABET:
                mine, between = self.step(pair[0], symbol)
                theirs, out = other.step(pair[1], between)
                if (mine, theirs) not in number:
                    number[mine, theirs] = len(number)
                    waiting.append((mine, theirs))
                arcs[number[pair], symbol] = (number[mine, theirs], out)
        return Transducer(arcs)


def negation() -> Transducer:
    """After a negation the next ``REACH`` words are denied."""
    arcs = {}
    for left in range(REACH + 1):
        arcs[left, NEGATION_] = (REACH, NEGATION_)
        arcs[left, OTHER] = (max(0, left - 1), OTHER)
        for s in (INSULT_, THREAT_):
            arcs[left, s] = (max(0, left - 1), s + DENIED if left else s)
    return Transducer(arcs)


def reported() -> Transducer:
    """After a verb of saying the rest of the clause is quoted."""
    arcs = {(0, REPORTED_): (1, REPORTED_)}
    for s in (INSULT_, THREAT_):
        arcs[1, s] = (1, s + QUOTED)
        arcs[1, s + DENIED] = (1, s + QUOTED_DENIED)
    return Transducer(arcs)


def aimed() -> Transducer:
    """A target shortly before an insult or threat makes it aimed (``!``)."""
    arcs = {}
    marked = [s + m for s in (INSULT_, THREAT_) for m in ("", DENIED, QUOTED, QUOTED_DENIED)]
    for left in range(REACH + 1):
        arcs[left, TARGET_] = (REACH, TARGET_)
        arcs[left, OTHER] = (max(0, left - 1), OTHER)
        for s in marked:
            arcs[left, s] = (max(0, left - 1), s + "!" if left else s)
    return Transducer(arcs)


GRAMMAR = negation().then(reported()).then(aimed())


def terms(word: str) -> list[str]:
    """The lexicon entries a word can match: itself, and its beginnings (``stem*``)."""
    return [word, *(word[:n] + "*" for n in range(STEM[0], min(STEM[1], len(word) - 1) + 1))]


@dataclass
class Model:
    """What scoring needs: term weights, and the logistic weights over ``features``."""

    insults: dict[str, float]
    coefficients: list[float] = field(default_factory=lambda: [0.0] * (1 + N_FEATURES))
    aimed: float = 1.5
    threat: float = 2.0

    def __post_init__(self) -> None:
        self.classes = {w: c for c, ws in ((TARGET_, TARGET), (NEGATION_, NEGATION), (REPORTED_, REPORTED), (THREAT_, THREAT)) for w in ws}
        self.threats = set(THREAT)
        self.known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        """The word's insult weight by its strongest entry, 0 if it has none."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) > 1_000_000:
                self.known.clear()
            found = 0.0 if word in self.classes else max(self.insults.get(t, 0.0) for t in terms(word))
            self.known[word] = found
        return found

    def kind(self, word: str) -> str:
        if self.weight(word):
            return INSULT_
        return self.classes.get(word) or (NEGATION_ if word.endswith("n't") else OTHER)

    def marked(self, words: list[str]) -> list[str]:
        """The symbols of a clause's words as the grammar marks them."""
        return GRAMMAR.run([self.kind(w) for w in words])

    def clause(self, words: list[str], symbols: list[str]) -> float:
        """The weight of one marked clause; threats count only when they are aimed."""
        total = 0.0
        for word, s in zip(words, symbols):
            if s[0] in (INSULT_, THREAT_) and (s[0] == INSULT_ or s[-1] == "!"):
                weight = self.weight(word) if s[0] == INSULT_ else self.threat
                for mark in s[1:]:
                    weight *= FACTOR.get(mark, self.aimed)
                total += weight
        return total

    def features(self, text: str | None) -> tuple[float, ...]:
        """Logs of: sum and peak of the clause weights, density per 1000 words, different terms, their occurrences.

        An occurrence that is denied or quoted counts as its ``FACTOR``, a term as the most of its occurrences.
        """
        lower = (text or "").lower()
        words = TOKEN.findall(lower)
        found = {w for w in set(words) if self.weight(w) or w in self.threats}
        if not found:
            return (0.0,) * N_FEATURES
        total = peak = times = 0.0
        most: dict[str, float] = {}
        for clause in CLAUSE.findall(lower):
            own = TOKEN.findall(clause)
            if not found.isdisjoint(own):
                symbols = self.marked(own)
                weight = self.clause(own, symbols)
                total, peak = total + weight, max(peak, weight)
                for word, s in zip(own, symbols):
                    if s[0] == INSULT_:
                        share = FACTOR.get(s[1:2], 1.0)
                        times += share
                        most[word] = max(most.get(word, 0.0), share)
        return (math.log1p(total), math.log1p(peak), math.log1p(1000 * total / len(words)), math.log1p(sum(most.values())), math.log1p(times))

    def score(self, text: str | None) -> float:
        z = self.coefficients[0] + float(np.dot(self.coefficients[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 60) -> np.ndarray:
    """Newton steps on the penalised log-likelihood; the first coefficient is the constant."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        move = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return w


def without_shadows(entries: list, toxic: float, clean: float, min_rows: int, min_weight: float) -> list:
    """Leaves out word beginnings whose evidence is that of one longer entry."""
    longer: dict[str, list] = {}  # by beginning: the longer entries that share it, and the word that is no more than it
    for x in entries:
        stem = x["word"].removesuffix("*")
        for n in range(STEM[0], min(STEM[1], len(x["word"]) - 2) + 1):
            longer.setdefault(stem[:n] + "*", []).append(x)
        if x["word"][-1] != "*":
            longer.setdefault(stem + "*", []).append(x)
    kept = []
    for e in entries:
        if e["word"] in longer:
            top = max(longer[e["word"]], key=lambda x: x["t"])
            t, c = e["t"] - top["t"], max(0, e["c"] - top["c"])
            if t < min_rows or math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1)) < min_weight:
                continue
        kept.append(e)
    return kept


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_rows: int = 40_000, min_root: float = 4.5, min_rows: int = 4, min_weight: float = 2.0) -> Model:
    """A model from labelled rows: ``labels`` has ``id_col`` and ``label_col`` (1: toxic; null: no label).

    The classifier is fitted on at most ``max_rows`` labelled rows (those whose ids hash lowest, 16 bytes each, so
    they are broadcast). Equal texts with the same label count once among them. A word or word beginning is an entry if
    the root of its likelihood ratio against independence of the label reaches ``min_root`` and its log odds reach
    ``min_weight``. All entries make the lexicon; as each needs ``min_rows`` toxic texts, it is bounded by
    ``max_rows`` and not by the table. Without labels of both kinds every score is the prior.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    order = F.xxhash64(F.col(id_col))
    sample = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y"), order.alias("__h")).dropna()
    sample = sample.orderBy("__h", "__id", "__y").limit(max_rows)
    label = F.when(F.col("__y") > 0, 1).otherwise(0).alias("y")
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "__id").select("text", label)
    same = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("same")
    rows = written(rows.groupBy(same, "y").agg(F.any_value("text").alias("text")).drop("same"), "labelled")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            texts = [0, 0]
            for text, y in zip(batch["text"], batch["y"]):
                if text:
                    seen[y].update({t for w in set(TOKEN.findall(text.lower())) for t in terms(w)})
                    texts[y] += 1
            words = list(set(seen[0]) | set(seen[1]))
            yield pd.DataFrame({"word": [*words, ""], "clean": [*(seen[0][w] for w in words), texts[0]],
                                "toxic": [*(seen[1][w] for w in words), texts[1]]})

    counts = (
        rows.select("text", "y").mapInPandas(count, "word string, clean long, toxic long")
        .groupBy("word").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t")))
    counts = written(counts.filter((F.col("t") >= min_rows) | (F.col("word") == "")), "terms")
    totals = {"c": 0, "t": 0}
    total = counts.filter("word = ''").first()
    if total:
        totals = {"c": total["c"], "t": total["t"]}
    toxic, clean = float(totals["t"]), float(totals["c"])
    part = lambda n, of: F.when(n > 0, n * F.log(n / of)).otherwise(0.0)
    t, c, share = F.col("t"), F.col("c"), toxic / max(1.0, toxic + clean)
    both = t + c
    ratio = 2 * (part(t, both * share) + part(c, both * (1 - share)) + part(toxic - t, (toxic + clean - both) * share)
                 + part(clean - c, (toxic + clean - both) * (1 - share)))
    log_odds = F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))
    entries = counts.filter("word <> ''").select("word", "t", "c", log_odds.alias("w"), F.sqrt(F.greatest(ratio, F.lit(0.0))).alias("root")).filter(
        (F.col("root") >= min_root) & (F.col("w") >= min_weight)).orderBy(F.desc("root"), "word").collect()
    closed = {*NEGATION, *REPORTED, *TARGET, *THREAT}
    model = Model({r["word"]: float(r["w"]) for r in without_shadows(entries, toxic, clean, min_rows, min_weight) if r["word"] not in closed})

    names = [f"f{i}" for i in range(N_FEATURES)]

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            f = np.array([model.features(t) for t in batch["text"]]).reshape(-1, N_FEATURES)
            yield pd.DataFrame({**{name: f[:, i] for i, name in enumerate(names)}, "y": batch["y"]})

    found = rows.select("text", "y").mapInPandas(measure, ", ".join(f"{n} double" for n in names) + ", y int").toPandas()
    found = found.sort_values([*names, "y"])  # sums go by value, not by the order of tasks
    if len(found):
        positive = float(found["y"].mean())
        if 0 < positive < 1:
            model.coefficients = fit_logistic(found[names].to_numpy(), found["y"].to_numpy(float)).tolist()
        else:
            model.coefficients[0] = 3.0 if positive else -3.0
    else:
        model.coefficients[0] = -3.0
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` (0 to 1) of every row; a null or empty text scores what no evidence scores."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": [model.score(t) for t in batch["text"]]})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: Model, bound: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``bound``, their columns unchanged."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def toxic(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts])

    return docs.filter(toxic(F.col(text_col)) < bound)

"""Toxicity by a weighted finite-state pattern grammar.

Four small transducers read the words of a clause: polarity (a negation
weakens what follows it for a few words), stance (a verb of reporting or an
opening quote weakens what is reported), address (a person or pronoun in the
clause strengthens it) and threat (an intent followed by a violent verb, with
somebody to suffer it).  They are composed into one machine whose states are
tuples; its arcs weigh the insults that are read and its final weights the
whole clause.  A document's features are sums and maxima over its clauses,
not over isolated words, and a logistic model turns them into a score.

The insult lexicon and the model are fitted on labelled rows whose
crc32(doc_id as text) mod 5 is not 0, of which at most about ``SAMPLE`` rows
are taken by a hash of the identifier.  Words and word beginnings (4 to 8
characters, so that inflected forms are reached in any language) enter the
lexicon by their log-odds between toxic and other rows.  Labels, language,
source and identifiers are no inputs of a score.

Matching is by one Aho-Corasick automaton over the text: only clauses with a
hit are read word by word.

Defined cases: null text = empty text, scored by the model's intercept;
repeated rows are scored each; labels given twice count once (the larger);
without labelled rows of both kinds the fixed lexicon and default weights are
used; a null identifier counts as held out; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import documents, labels, stage, text_or_empty

#: Labelled rows that the lexicon and the model are fitted on, about.
SAMPLE = 8_000
#: Entries of the learned lexicon at most, and the support of each.
LEXICON, SUPPORT = 4_000, 6

# Fixed word lists of the grammar.
INSULTS = ("idiot", "moron", "stupid", "scum", "loser", "trash", "clown", "pathetic", "worthless", "disgusting")
INTENTS = ("will", "shall", "gonna", "must", "should", "wanna", "going", "i'll", "we'll", "i'm", "we're")
VIOLENCE = ("kill", "hurt", "destroy", "murder", "beat", "stab", "shoot", "burn", "hang", "crush")
PERSONS = ("you", "your", "you're", "yourself", "u", "he", "she", "him", "her", "they", "them", "their", "people")
NEGATIONS = ("not", "never", "no", "isn't", "aren't", "don't", "doesn't", "wasn't", "won't", "cannot", "nobody")
REPORTS = ("said", "says", "say", "wrote", "writes", "claimed", "claims", "called", "quoted", "quotes", "reported")
TURNS = ("but", "however", "although", "yet")



def inflected(verb: str) -> set[str]:
    """A verb with its regular endings (a last e dropped, a last letter doubled)."""
    stems = {verb, verb.removesuffix("e"), verb + verb[-1]}
    return {verb, verb + "s", verb + "es"} | {stem + end for stem in stems for end in ("ing", "ed")}


_CLASSES = {w: "violence" for verb in VIOLENCE for w in inflected(verb)} | {
    w: c for c, ws in (("intent", INTENTS), ("person", PERSONS), ("negation", NEGATIONS), ("report", REPORTS),
                       ("turn", TURNS)) for w in ws}
CLAUSE_ENDS = ".!?;:\n"
_CLAUSE_END = re.compile(f"[{CLAUSE_ENDS}]")
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[\"“”«»]")
NEGATION_SCOPE = 4


@dataclass
class Transducer:
    """States by (state, class) -> state; a weight for insults read in a
    state; a weight for clauses that end in it.  Missing arcs stay put."""

    start: object
    arcs: dict = field(default_factory=dict)
    weight: dict = field(default_factory=dict)
    final: dict = field(default_factory=dict)

    def step(self, state, kind):
        return self.arcs.get((state, kind), self.arcs.get((state, "*"), state))


def compose(parts: list[Transducer], kinds: list[str]) -> Transducer:
    """The machine that runs all parts at once; weights multiply."""
    start = tuple(p.start for p in parts)
    whole, todo = Transducer(start), [start]
    while todo:
        state = todo.pop()
        if state in whole.weight:
            continue
        whole.weight[state] = math.prod(p.weight.get(s, 1.0) for p, s in zip(parts, state))
        whole.final[state] = math.prod(p.final.get(s, 1.0) for p, s in zip(parts, state))
        for kind in kinds:
            to = tuple(p.step(s, kind) for p, s in zip(parts, state))
            whole.arcs[state, kind] = to
            todo.append(to)
    return whole


KINDS = ["insult", "intent", "violence", "person", "negation", "report", "turn", "quote", "other"]


def grammar() -> Transducer:
    polarity = Transducer(0, {(s, "*"): s - 1 for s in range(1, NEGATION_SCOPE + 1)}
                          | {(s, "negation"): NEGATION_SCOPE for s in range(NEGATION_SCOPE + 1)}
                          | {(s, "turn"): 0 for s in range(NEGATION_SCOPE + 1)},
                          {s: 0.25 for s in range(1, NEGATION_SCOPE + 1)})
    stance = Transducer("own", {("own", "report"): "told", ("own", "quote"): "quoted", ("quoted", "quote"): "own",
                                ("told", "quote"): "quoted", ("told", "turn"): "own"}, {"told": 0.5, "quoted": 0.5})
    address = Transducer("none", {("none", "person"): "person"}, {}, {"person": 1.5})
    threat = Transducer("calm", {("calm", "intent"): "intent", ("calm", "violence"): "act", ("intent", "violence"): "threat",
                                 ("intent", "turn"): "calm"}, {}, {})
    return compose([polarity, stance, address, threat], KINDS)


N_FEATURES = 7


class Scorer:
    """The grammar with a lexicon: features of texts."""

    def __init__(self, lexicon: dict[str, float]):
        import ahocorasick

        self.machine = grammar()
        self.lexicon = dict(lexicon)
        self.find = ahocorasick.Automaton()
        # a word may be an entry both whole and as a beginning
        whole: dict[str, bool] = {}
        for entry in lexicon:
            key = entry.rstrip("$")
            whole[key] = whole.get(key, True) and entry.endswith("$")
        for key in [*whole, *(w for w in VIOLENCE if w not in whole)]:
            self.find.add_word(key, (len(key), whole.get(key, False)))
        self.find.make_automaton()

    def word_weight(self, word: str) -> tuple[float, str]:
        best, which = 0.0, ""
        for entry in (word + "$", word, *(word[:k] for k in range(4, min(9, len(word))))):
            w = self.lexicon.get(entry, 0.0)
            if w > best:
                best, which = w, entry
        return best, which

    def clause(self, text: str, entries: set) -> tuple[float, float, float]:
        """(score, suppressed weight, threat) of one clause."""
        m, state = self.machine, self.machine.start
        score = raw = 0.0
        for token in _TOKEN.findall(text):
            if not token[0].isalpha():
                kind = "quote"
            else:
                kind = _CLASSES.get(token.replace("’", "'"), "other")
                weight, entry = self.word_weight(token)
                if weight:
                    entries.add(entry)
                    raw += weight
                    score += weight * m.weight[state]
                    if kind == "other":
                        kind = "insult"
            state = m.arcs[state, kind]
        polarity, stance, address, threat = state
        threatened = 0.0
        if threat == "threat" and address == "person":
            threatened = 2.0 * (0.5 if stance != "own" else 1.0)
        return score * m.final[state], raw - min(raw, score), threatened

    def features(self, text: str) -> list[float]:
        low = text.lower()
        total = most = hidden = threat = 0.0
        entries: set[str] = set()
        until = -1
        for end, (n, only_whole) in self.find.iter(low):
            begin = end - n + 1
            if begin < until or (begin and low[begin - 1].isalpha()):
                continue
            if only_whole and end + 1 < len(low) and low[end + 1].isalpha():
                continue
            # the clause around the hit, read once; what lies before is searched once too
            a = max(until, 0)
            a = max(a, 1 + max(low.rfind(c, a, begin) for c in CLAUSE_ENDS))
            found = _CLAUSE_END.search(low, end)
            until = found.start() if found else len(low)
            s, h, t = self.clause(low[a:until], entries)
            total += s
            hidden += h
            threat += t
            most = max(most, s)
        size = len(low) + 200
        return [math.log1p(total), math.log1p(1000 * total / size), math.log1p(most), math.log1p(len(entries)),
                math.log1p(1000 * len(entries) / size), math.log1p(hidden), math.log1p(threat)]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge-regularised logistic regression by Newton's method; the last
    weight is the intercept."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + penalty * w
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty)
        d = np.linalg.solve(h, g)
        w -= d
        if np.abs(d).max() < 1e-8:
            break
    return w


#: Used when there is nothing to learn from.
DEFAULT_WEIGHTS = [0.5, 0.5, 1.0, 0.5, 0.5, -0.2, 1.5, -3.0]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, marks: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """About ``sample`` labelled rows at most (text, toxic), by hash of the identifier."""
    known = (marks.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = known.count()
    part = min(1_000_000, int(1_000_000 * sample / max(n, 1)))
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < part
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return d.filter(pick).join(known.filter(pick), "doc_id").select("text", "toxic")


def learn_lexicon(rows: DataFrame, size: int = LEXICON, support: int = SUPPORT) -> dict[str, float]:
    """Words (with a ``$`` at the end) and word beginnings by log-odds; at
    most ``size`` entries reach the driver."""
    words = F.filter(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+")), lambda w: F.length(w) >= 4)
    forms = F.transform(words, lambda w: F.array(
        F.concat(w, F.lit("$")), *[F.when(F.length(w) >= k, F.substring(w, 1, k)) for k in range(4, 9)]))
    each = rows.select("toxic", F.explode(F.array_distinct(F.flatten(forms))).alias("form")).filter("form IS NOT NULL")
    total = rows.agg(F.sum("toxic").alias("pos"), F.count(F.lit(1)).alias("n")).first()
    pos, neg = total["pos"] or 0, total["n"] - (total["pos"] or 0)
    if not pos or not neg:
        return {}
    odds = (F.log((F.col("a") + 0.5) / (pos + 1.0)) - F.log((F.col("n") - F.col("a") + 0.5) / (neg + 1.0)))
    counted = each.groupBy("form").agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n"))
    best = (counted.filter(F.col("a") >= support).withColumn("w", odds).filter("w >= 1.5")
            .orderBy(F.desc(F.col("w") * F.sqrt("a")), "form").limit(size))
    return {r["form"]: round(min(r["w"], 5.0), 6) for r in best.select("form", "w").collect()}


def _features(batches: Iterator[pa.RecordBatch], lexicon: dict) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(lexicon)
    for batch in batches:
        rows = [scorer.features(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(rows, pa.list_(pa.float64()))],
                                         names=["toxic", "x"])


@dataclass
class Model:
    lexicon: dict[str, float]
    weights: list[float]

    def scorer(self):
        s, w = Scorer(self.lexicon), self.weights

        def score(text: str) -> float:
            z = w[-1] + sum(a * b for a, b in zip(w, s.features(text)))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
        return score


def fit(docs: DataFrame, marks: DataFrame, sample: int = SAMPLE) -> Model:
    """Lexicon and weights from the bounded sample of training rows."""
    rows = stage(training_rows(docs, marks, sample), "toxic-sample")
    lexicon = learn_lexicon(rows)
    whole = {w + "$": 2.0 for w in INSULTS} | lexicon
    if not lexicon:
        return Model(whole, DEFAULT_WEIGHTS)
    got = rows.mapInArrow(lambda it: _features(it, whole), "toxic int, x array<double>").collect()
    x = np.array([r["x"] for r in got])
    y = np.array([r["toxic"] for r in got], dtype=float)
    return Model(whole, [round(float(v), 9) for v in fit_logistic(x, y)])


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every document."""
    def run(batches):
        score = model.scorer()
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([score(t.as_py()) for t in b.column("text")], pa.float64())],
                names=["doc_id", "score"])
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return d.mapInArrow(run, "doc_id long, score double")


def clean_rows(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they came."""
    at = docs.columns.index(text_col)

    def run(batches):
        score = model.scorer()
        for b in batches:
            keep = [score(t.as_py() or "") < threshold for t in b.column(at)]
            yield b.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def op10_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = fit(docs, labels(spark, sf_dir))
    s = scores(docs, model)
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"))

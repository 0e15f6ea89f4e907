"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols (insult, threat, ambiguous threat, subject, target,
negation, report, contrast, boundary, stop, colon, comma, quote or other) and
sequential transducers rewrite the symbols of a clause:

    target ahead o subject o negation o report o target o scoring

The first reads from right to left and marks insults and threats that a target
follows; the others read from left to right. Verbs that also mean something
harmless (``AMBIGUOUS_THREATS``) are threats only behind a first-person or modal
subject. Negation marks insults and threats until its clause ends, report those
in reported speech, target those aimed at someone; scoring emits one clause type
with each. What reads from left to right is composed once into a single table of
states. A threat without a target is no match, and an insult counts by the
clause it stands in, so the score of a text depends on matched clauses, never on
a word alone. Known words are given in their base form; :func:`forms` adds plurals,
degrees and tenses by rule.

Weights come from labels: the weight of an insult is its log-odds in labelled
training texts (``SAMPLE_ROWS`` of them at most, outside the held-out third). A
lexicon entry is a word or a stem, that is a word's first letters; each one for
which a likelihood-ratio test rules out chance is kept, and a word takes the
weight of its longest entry. The sample bounds them, whatever the corpus. A few well-known words start with a weight of their own. Logistic
regression on the other part of the sample turns a text's clauses into a
probability. Equal texts count once in learning, so that copies do not pass for
evidence; of unlike labels the smaller one counts. Language and source are no inputs.

Defined cases: null and empty texts have no clause and get the score of that;
with no labelled rows, or one class only, the regression is the fixed
:data:`PRIOR`; repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import as_bytes, labelled_sample, materialise

SAMPLE_ROWS = 15_000
MAX_WEIGHT = 6.0
STEM = range(4, 8)

INSULTS = "idiot moron stupid scum trash loser worthless pathetic disgusting clown dumb bastard imbecile filth vermin"
INSULTS += " dummkopf abschaum arschloch versager imbécile crétin salaud ordure idiota estúpido imbécil asqueroso"
NOUN_ENDINGS = "s es en er est ly ed ing"
# Verbs by language: the words, their endings, and the ending that these replace.
THREATS = (
    ("kill hurt destroy murder stab strangle slaughter", "s ed ing", ""),
    ("töten umbringen", "e est et t te ten", "en"),
    ("tuer frapper", "e es ent ez é ée és", "er"),
    ("matar golpear", "o as a an é ado ando aré", "ar"),
)
AMBIGUOUS_THREATS = (("beat shoot burn smash crush hang break", "s ed ing en", ""),)
IRREGULAR = {"shoot": "shot", "hang": "hung", "break": "broke broken"}
SUBJECTS = "i we will shall should must gonna ll going let lets ich wir werde werden je nous vais allons yo nosotros voy vamos"
CONTRASTS = "but yet however aber sondern mais pero sino"
TARGETS = "you your yours yourself u he she they him them dich dir euch ihr tu toi vous ils elles tú usted ustedes ellos"
NEGATIONS = "not no never neither nor nobody cannot nicht kein keine nie niemals pas jamais aucun nunca jamás ningún"
NEGATIONS += " don't doesn't didn't isn't aren't wasn't weren't won't wouldn't can't couldn't shouldn't mustn't needn't mightn't"
NEGATIONS += " haven't hasn't hadn't shan't ain't"
REPORTS = "said says say wrote told called calls claimed quoted quote sagte schrieb nannte dit écrit appelle dijo escribió llamó"

# Symbols. A transducer passes on what it does not rewrite.
OTHER, BOUNDARY, INSULT, THREAT, TARGET, NEGATION, REPORT = "w", "|", "I", "H", "T", "N", "R"
AMBIGUOUS, SUBJECT, CONTRAST, STOP, COLON, COMMA, QUOTE = "A", "S", "B", ".", ":", ",", "q"
SYMBOLS = (OTHER, BOUNDARY, INSULT, THREAT, TARGET, NEGATION, REPORT, AMBIGUOUS, SUBJECT, CONTRAST, STOP, COLON, COMMA, QUOTE)
ENDS = (BOUNDARY, STOP, COLON)
SILENT = (COMMA, QUOTE)
MARKS = {"\n": BOUNDARY, ":": COLON, ",": COMMA} | dict.fromkeys(".!?;", STOP) | dict.fromkeys('"“”„«»', QUOTE)
TYPES = ("insult", "aimed insult", "aimed threat", "negated", "reported")

_TOKEN = re.compile(r"""[^\W\d_]*n't(?![^\W\d_])|[^\W\d_]+|[.!?;:,\n"“”„«»]""")


@dataclass
class Transducer:
    """A sequential transducer: ``step(state, symbol) -> (state, output)``, tabulated from its start state."""

    start: object
    moves: dict = field(default_factory=dict)

    @classmethod
    def tabulate(cls, start, alphabet, step) -> Transducer:
        made, waiting = cls(start), [start]
        seen = {start}
        while waiting:
            state = waiting.pop()
            for symbol in alphabet:
                following, output = made.moves[state, symbol] = step(state, symbol)
                if following not in seen:
                    seen.add(following)
                    waiting.append(following)
        return made

    def outputs(self) -> list:
        return list(dict.fromkeys(output for _, output in self.moves.values()))

    def then(self, other: Transducer) -> Transducer:
        """Composition: ``other`` reads what this one writes."""
        symbols = list(dict.fromkeys(symbol for _, symbol in self.moves))

        def step(state, symbol):
            first, middle = self.moves[state[0], symbol]
            second, output = other.moves[state[1], middle]
            return (first, second), output

        return Transducer.tabulate((self.start, other.start), symbols, step)

    def run(self, symbols) -> list:
        state, out = self.start, []
        for symbol in symbols:
            state, output = self.moves[state, symbol]
            out.append(output)
        return out


@dataclass
class TwoWay:
    """A transducer that reads from right to left, then one from left to right over what it writes."""

    back: Transducer
    forth: Transducer

    def run(self, symbols) -> list:
        return self.forth.run(self.back.run(symbols[::-1])[::-1])


def transducers(lead: int = 4, reach: int = 6) -> list[Transducer]:
    """The chain, each one reading what the one before writes; the first reads from right to left.

    A subject reaches over the next ``lead`` words, unless a target begins
    another clause; a target over the next and the last ``reach``. Negation
    lasts until the clause ends, at a contrast or at a comma that a target
    follows; reported speech until the clause ends, beyond a colon, and in
    quotation marks until they close or the line ends.
    """

    def ahead(left, symbol):
        if symbol in ENDS:
            return 0, symbol
        if symbol == TARGET:
            return reach, symbol
        if symbol in SILENT:
            return left, symbol
        return max(0, left - 1), symbol + "@" if left and symbol in (INSULT, THREAT, AMBIGUOUS) else symbol

    def subject(left, symbol):
        if symbol in ENDS or symbol == TARGET:
            return 0, symbol
        if symbol == SUBJECT:
            return lead, OTHER
        if symbol in SILENT or symbol == NEGATION:
            return left, symbol
        if symbol[0] == AMBIGUOUS:
            symbol = THREAT + symbol[1:] if left else OTHER
        return max(0, left - 1), symbol

    def negation(state, symbol):
        """0: not negated, 1: negated, 2: negated, and a comma was just read."""
        if symbol in ENDS or symbol == CONTRAST or (symbol == TARGET and state == 2):
            return 0, OTHER if symbol == CONTRAST else symbol
        if symbol == NEGATION:
            return 1, OTHER
        if symbol in SILENT:
            return 2 if state and symbol == COMMA else state, symbol
        return min(state, 1), symbol + "-" if state and symbol[0] in (INSULT, THREAT) else symbol

    def report(inside, symbol):
        """0: not reported, 1: until the clause ends, 2: until the quotation marks close."""
        if symbol == BOUNDARY or (symbol == STOP and inside < 2):
            return 0, symbol
        if symbol == REPORT:
            return max(1, inside), OTHER
        if symbol == QUOTE:
            return (0, 2, 1)[inside], symbol
        return inside, symbol + '"' if inside and symbol[0] in (INSULT, THREAT) else symbol

    def target(left, symbol):
        if symbol in ENDS:
            return 0, symbol
        if symbol == TARGET:
            return reach, OTHER
        if symbol in SILENT:
            return left, symbol
        return max(0, left - 1), symbol + "@" if left and symbol[0] in (INSULT, THREAT) else symbol

    def scoring(_, symbol):
        if symbol[0] not in (INSULT, THREAT) or (symbol[0] == THREAT and "@" not in symbol):
            return 0, None
        if "-" in symbol:
            return 0, "negated"
        if '"' in symbol:
            return 0, "reported"
        return 0, "aimed threat" if symbol[0] == THREAT else "aimed insult" if "@" in symbol else "insult"

    chain = [Transducer.tabulate(0, SYMBOLS, ahead)]
    for step in (subject, negation, report, target, scoring):
        chain.append(Transducer.tabulate(0, chain[-1].outputs(), step))
    return chain


def grammar(lead: int = 4, reach: int = 6) -> TwoWay:
    """The chain of :func:`transducers`, composed; outputs are clause types or None."""
    back, *forth = transducers(lead, reach)
    return TwoWay(back, reduce(Transducer.then, forth))


def forms(word: str, endings: str, dropped: str = "") -> set[str]:
    """The word's stem, which is what is left without ``dropped``, with each ending.

    A last ``e`` falls before vowels, and a last consonant behind a single vowel may double.
    """
    stem = word.removesuffix(dropped)
    made = {word} | {(stem[:-1] if stem[-1] == "e" and end[0] in "ei" else stem) + end for end in endings.split()}
    if not dropped and re.fullmatch(r"[^aeiou]*[aeiou][^aeiouwxy]", stem):
        made |= {stem + stem[-1] + end for end in endings.split() if end in ("ed", "ing", "er", "est")}
    return made


@dataclass
class Lexicon:
    """Words and stems (``letters*``) with weights; words with symbols."""

    weights: dict[str, float]
    symbols: dict[str, str]
    heads: set[str]

    @classmethod
    def of(cls, learned: dict[str, float]) -> Lexicon:
        symbols, base = {}, {}
        for words, symbol in ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT), (SUBJECTS, SUBJECT), (CONTRASTS, CONTRAST)):
            symbols.update(dict.fromkeys(words.split(), symbol))
        steers = set(symbols)
        known = [(INSULT, INSULTS, NOUN_ENDINGS, "")]
        known += [(symbol, *verbs) for symbol, group in ((THREAT, THREATS), (AMBIGUOUS, AMBIGUOUS_THREATS)) for verbs in group]
        for symbol, words, endings, dropped in known:
            for word in words.split():
                for form in (forms(word, endings, dropped) | set(IRREGULAR.get(word, "").split())) - steers:
                    symbols[form], base[form] = symbol, word
        # What steers the transducers is no insult, however it is spread; nor is a stem that covers it.
        steering = steers | {w[:k] + "*" for w in steers for k in STEM if k < len(w)}
        learned = {w: min(MAX_WEIGHT, x) for w, x in learned.items() if w not in steering}
        symbols.update({w: INSULT for w in learned if symbols.get(w) not in (THREAT, AMBIGUOUS)})
        weights = {form: learned.get(word, 3.0) for form, word in base.items()} | learned
        return cls(weights, symbols, {w[: STEM[0]] for w in weights})

    def entry(self, word: str) -> str | None:
        """The longest entry that the word matches."""
        if word in self.weights:
            return word
        stems = (word[:k] + "*" for k in reversed(STEM) if k < len(word))
        return next((stem for stem in stems if stem in self.weights), None)

    def matches(self, words: set[str]) -> dict[str, str]:
        found = {w: self.entry(w) for w in words if w[: STEM[0]] in self.heads}
        return {w: entry for w, entry in found.items() if entry is not None}


WIDTH = 2 * len(TYPES) + 3
# Weights of the regression where nothing can be learned; the order is that of clause_features, the last is the constant.
PRIOR = np.array([1.0, 1.0, 1.0, -0.5, -0.5] + [0.0] * len(TYPES) + [0.5, 0.3, -4.0])


def words_of(text: str) -> list[str]:
    return _TOKEN.findall(text.lower().replace("’", "'"))


def clause_features(text: str, lexicon: Lexicon, chain: TwoWay) -> np.ndarray:
    """Per clause type the summed weight and the largest one, distinct matched words, matches a word, 1."""
    tokens = words_of(text)
    sums, tops = dict.fromkeys(TYPES, 0.0), dict.fromkeys(TYPES, 0.0)
    matched, hits = set(), 0
    entries = lexicon.matches(set(tokens))
    if entries:
        symbols = [lexicon.symbols.get(entries.get(x, x), MARKS.get(x, OTHER)) for x in tokens]
        for token, kind in zip(tokens, chain.run(symbols), strict=True):
            if kind is not None:
                weight = lexicon.weights[entries[token]]
                sums[kind] += weight
                tops[kind] = max(tops[kind], weight)
                matched.add(token)
                hits += 1
    density = math.log1p(1000 * hits / (len(tokens) + 1))
    return np.array([*(math.log1p(sums[k]) for k in TYPES), *(tops[k] for k in TYPES), math.log1p(len(matched)), density, 1.0])


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column is the constant."""
    if len(np.unique(y)) < 2:
        return PRIOR.copy()
    w, ridge = np.zeros(x.shape[1]), penalty * np.eye(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, x.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    regression: np.ndarray


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, toxic = [], []
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            own = {w for w in words_of(text.decode("utf-8", "replace")) if w[0].isalpha()}
            own |= {w[:k] + "*" for w in own for k in STEM if k < len(w)}
            words.extend(own)
            toxic.extend([label] * len(own))
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(toxic, pa.int64())], ["word", "toxic"])


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Log-odds of all words and stems that mark label 1, from ``(text, label)``: a sample, so they reach the driver."""
    n, positive = rows.agg(F.count("*"), F.sum("label")).first()
    if not positive or positive == n:
        return {}
    counts = rows.mapInArrow(_word_rows, "word string, toxic long").groupBy("word").agg(
        F.count("*").alias("n"), F.sum("toxic").alias("a")
    )
    counts = materialise(counts.filter("n > 1"), "words")
    tested = counts.count()
    share = F.lit(positive / n)
    expected = F.col("n") * share

    def part(seen: Column, due: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / due)).otherwise(0.0)

    g2 = 2 * (part(F.col("a"), expected) + part(F.col("n") - F.col("a"), F.col("n") - expected))
    odds = F.log((F.col("a") + 0.5) / (positive + 1)) - F.log((F.col("n") - F.col("a") + 0.5) / (n - positive + 1))
    marked = counts.filter((F.col("a") > expected) & (g2 >= 2 * math.log(max(2, tested)))).select("word", odds.alias("odds"))
    return {row["word"]: float(row["odds"]) for row in marked.filter("odds > 1").collect()}


def merge_copies(sample: DataFrame) -> DataFrame:
    """``(text, label)`` with each text once."""
    return sample.groupBy("text").agg(F.min("label").alias("label"))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = SAMPLE_ROWS, text: str = "text") -> ToxicityModel:
    """Lexicon from two thirds of at most ``limit`` labelled rows, regression from the other third."""
    sample = labelled_sample(docs, labels, label, limit, text)
    sample = sample.select(as_bytes("_text").alias("text"), F.col("_label").cast("int").alias("label"))
    sample = materialise(merge_copies(sample).withColumn("part", F.pmod(F.xxhash64("text"), F.lit(3))), "sample")
    lexicon = Lexicon.of(learn_lexicon(sample.filter("part < 2").select("text", "label")))
    chain = grammar()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [clause_features(x.decode("utf-8", "replace"), lexicon, chain) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column("label")], ["x", "y"])

    rows = sample.filter("part = 2").select("text", "label").mapInArrow(run, "x array<double>, y int").toArrow()
    if not rows.num_rows:
        return ToxicityModel(lexicon, PRIOR.copy())
    x = np.array(rows["x"].to_pylist()).reshape(-1, WIDTH)
    y = rows["y"].to_numpy().astype(float)
    order = np.lexsort(np.column_stack([x, y]).T)
    return ToxicityModel(lexicon, fit_logistic(x[order], y[order]))


def toxicity_score(model: ToxicityModel, text: str | Column = "text") -> Column:
    """Probability of label 1 as a column."""
    chain, lexicon, regression = grammar(), model.lexicon, model.regression

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        x = [clause_features(t.decode("utf-8", "replace"), lexicon, chain) for t in texts.to_pylist()]
        margins = np.array(x).reshape(-1, WIDTH) @ regression
        return pa.array(1 / (1 + np.exp(-np.clip(margins, -40, 40))), pa.float64())

    return of.asNondeterministic()(as_bytes(text))

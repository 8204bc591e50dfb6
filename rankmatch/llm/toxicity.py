"""Toxicity by a weighted finite-state grammar of clauses.

A lexicon transducer reads the letters of a word and writes its class: insult, slur, threat,
target, negation, reported speech or other; a slur is an insult only where it comes repeatedly.  Three small transducers then read the classes of a clause:
the first softens what a negation governs, the second marks what is reported or quoted, the
third ties insults and threats to a target close before or after them.  Their composition is
one automaton, whose arcs carry the weights of the patterns they complete.  A last transducer, with
one register, reads its output over the whole text: a hostile word soon after another one is a
barrage, and a clause that is little more than a hostile word is an outcry.  A document's log-odds
are those of its matched patterns, each weighed by the logarithm of one more than its matches.

A single hostile word outside these patterns scores nothing, however often the same one is repeated:
"the loser of the match" is no insult, "you loser", "Loser!" or "the pathetic loser" is.  A threat
needs a target.

The lexicon has fixed words for targets, negations, reports and threats.  Insults are learned:
stems, that is word beginnings or whole words, whose first, second or third occurrence tells toxic
documents of a bounded labelled sample from others, chosen one by one by how many toxic documents
they newly explain.  One whose first occurrence is a sure sign is an insult, else a slur.  The
weights of the patterns are learned from the same sample around prior weights.

Defined results: a null or empty text has no clause and gets the log-odds of a document without
a match; a null id, a repeated row and a tie are scored like any other; without a labelled
document of each class the prior weights stay and no insult is learned beyond the fixed ones; very
long texts are scored whole, one at a time; an empty table gives an empty result.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rankmatch.llm.common import Shared, by_texts, plain, training_rows

# The words of each class, in English, German, French and Spanish.
WORDS = {
    "insult": ("idiot", "moron", "stupid", "scum", "loser", "worthless", "pathetic"),
    "threat": ("kill", "hurt", "destroy", "beat", "shoot", "töten", "umbringen", "tuer", "frapper", "matar", "golpear"),
    "target": ("you", "your", "u", "he", "she", "they", "him", "her", "them", "du", "dich", "ihr", "euch", "sie",
               "tu", "toi", "vous", "ils", "elles", "usted", "ustedes", "ellos", "ellas"),
    "negation": ("not", "no", "never", "isn't", "aren't", "don't", "nicht", "kein", "keine", "nie", "pas", "jamais",
                 "nunca", "tampoco"),
    "report": ("said", "says", "wrote", "called", "quoted", "reported", "sagte", "schrieb", "nannte", "dit", "écrit",
               "dijo", "escribió", "llamó"),
}

HOSTILE = ("insult", "slur", "threat")
CLASSES = ("other", "slur", *WORDS, "quote")
# The patterns, and the prior weight of each: fixed values.
PATTERNS = {
    "direct insult": 2.5, "aimed": 1.0, "soft insult": 0.2, "told insult": 0.4,
    "direct slur": 1.0, "soft slur": 0.1, "told slur": 0.2,
    "direct threat": 1.5, "soft threat": 0.0, "told threat": 0.1,
    "barrage": 1.5, "barrage of slurs": 0.7, "outcry": 2.0,
}
_NUMBER = {name: i for i, name in enumerate(PATTERNS)}
# What the grammar writes for a hostile word that is neither negated nor reported, without threats.
_OPEN = {"insult": "barrage", "direct insult": "barrage", "slur": "barrage of slurs", "direct slur": "barrage of slurs"}
# Clauses between two hostile words of a barrage, and words of an outcry, at most.
_REACH = 12
_SHORT = 2
_TOKEN = re.compile(r"[^\W_]+(?:'[^\W_]+)?|[.!?;\n]|[\"“”„«»]")
_WORDS = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
_ENDS = ".!?;\n"


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer, all of whose states accept: (state, symbol) -> (state, output)."""

    start: object
    arcs: dict

    def __or__(self, other: Transducer) -> Transducer:
        """The composition: what this one writes, the other reads."""
        start = (self.start, other.start)
        arcs, waiting, seen = {}, [start], {start}
        alphabet = {symbol for _, symbol in self.arcs}
        while waiting:
            state = waiting.pop()
            for symbol in alphabet:
                mine, middle = self.arcs[state[0], symbol]
                theirs, out = other.arcs[state[1], middle]
                arcs[state, symbol] = ((mine, theirs), out)
                if (mine, theirs) not in seen:
                    seen.add((mine, theirs))
                    waiting.append((mine, theirs))
        return Transducer(start, arcs)

    def numbered(self) -> Transducer:
        """The same with small integers for states."""
        numbers: dict = {self.start: 0}
        for (state, _), (following, _) in self.arcs.items():
            numbers.setdefault(state, len(numbers))
            numbers.setdefault(following, len(numbers))
        return Transducer(0, {(numbers[s], x): (numbers[f], o) for (s, x), (f, o) in self.arcs.items()})


def negation(scope: int = 3) -> Transducer:
    """Hostile words within ``scope`` words after a negation come out soft."""
    arcs = {}
    for left in range(scope + 1):
        for symbol in CLASSES:
            out = f"soft {symbol}" if left and symbol in HOSTILE else symbol
            arcs[left, symbol] = (max(left - 1, 0), out)
        arcs[left, "negation"] = (scope, "other")
    return Transducer(0, arcs)


def reported() -> Transducer:
    """Hostile words after a verb of speech, or between quotation marks, come out as told."""
    arcs = {}
    for state in ("own", "said", "quoted"):
        for symbol in (*CLASSES, *(f"soft {h}" for h in HOSTILE)):
            told = state != "own" and symbol in HOSTILE
            arcs[state, symbol] = (state, f"told {symbol}" if told else symbol)
        arcs[state, "report"] = ("said" if state == "own" else state, "other")
        arcs[state, "quote"] = ("own" if state == "quoted" else "quoted", "other")
    return Transducer("own", arcs)


def targets(reach: int = 4) -> Transducer:
    """Hostile words up to ``reach`` words after a target are direct; a target so close after one is aimed at."""
    arcs = {}
    middle = (*CLASSES, *(f"{how} {h}" for how in ("soft", "told") for h in HOSTILE))
    for target in range(reach + 1):
        for hostile in range(reach + 1):
            for symbol in middle:
                after = (max(target - 1, 0), max(hostile - 1, 0))
                out = symbol
                if symbol == "target":
                    after, out = (reach, 0), "aimed" if hostile else "other"
                elif symbol in HOSTILE:
                    out = f"direct {symbol}" if target else symbol
                    after = (after[0], 0 if target else reach)
                arcs[(target, hostile), symbol] = (after, out)
    return Transducer((0, 0), arcs)


GRAMMAR = (negation() | reported() | targets()).numbered()


@dataclass
class Lexicon:
    """A transducer from letters to a class: arcs of letters, and the class where a word may end or go on."""

    arcs: dict[tuple[int, str], int] = field(default_factory=dict)
    whole: dict[int, str] = field(default_factory=dict)
    begun: dict[int, str] = field(default_factory=dict)
    states: int = 1

    def add(self, letters: str, kind: str, prefix: bool) -> None:
        state = 0
        for letter in letters:
            if (state, letter) not in self.arcs:
                self.arcs[state, letter] = self.states
                self.states += 1
            state = self.arcs[state, letter]
        (self.begun if prefix else self.whole).setdefault(state, kind)

    def __call__(self, word: str) -> str:
        """The class of a lower-cased word: that of the whole word, else of its longest known beginning."""
        state, found = 0, "other"
        for letter in word:
            state = self.arcs.get((state, letter), -1)
            if state < 0:
                return found
            found = self.begun.get(state, found)
        return self.whole.get(state, found)


def lexicon(stems: Iterable[tuple[str, bool, bool]] = ()) -> Lexicon:
    """The fixed words and learned ``stems``: letters, whether they begin a word, whether they are a sure sign."""
    made = Lexicon()
    for kind, words in WORDS.items():
        for word in words:
            made.add(word, kind, prefix=False)
    for letters, prefix, sure in stems:
        made.add(letters, "insult" if sure else "slur", prefix)
    return made


def matches(text: str, words: Lexicon) -> np.ndarray:
    """How often each pattern of :data:`PATTERNS` is matched in the clauses of a whole text."""
    counts = np.zeros(len(PATTERNS))
    low = text.lower()
    kinds = {w: k for w in set(_WORDS.findall(low)) if (k := words(w)) != "other"}
    if not set(HOSTILE) & set(kinds.values()):
        return counts
    arcs, state, hostile, path = GRAMMAR.arcs, GRAMMAR.start, False, []
    register, clause, since, length, own = None, 0, 0, 0, False
    for match in chain(_TOKEN.finditer(low), (None,)):
        token = match[0] if match else "."
        if token in _ENDS:
            if hostile:
                for out in path:
                    counts[out] += 1
                counts[_NUMBER["outcry"]] += own and length <= _SHORT
            state, hostile, path, length, own = GRAMMAR.start, False, [], 0, False
            clause += 1
            continue
        word = token[0].isalnum()
        kind = kinds.get(token, "other") if word else "quote"
        length += word
        state, out = arcs[state, kind]
        hostile |= kind in HOSTILE
        if out in _NUMBER:
            path.append(_NUMBER[out])
        if out in _OPEN:
            own = True
            # The register holds the last such word: only another one goes on with a barrage.
            if register not in (None, token) and clause - since <= _REACH:
                path.append(_NUMBER[_OPEN[out]])
            register, since = token, clause
    return counts


def weighed(counts: np.ndarray) -> np.ndarray:
    """What the weights are multiplied with: further matches of a pattern add ever less, without an end."""
    return np.log1p(counts)


@dataclass(frozen=True)
class Settings:
    """``per_class`` bounds the training sample: so many labelled documents of either class, chosen by a
    seeded hash of the id, one row of each, among those of at most ``max_chars`` code points.  Stems have from
    ``shortest`` to ``longest`` letters; a document is explained once it has ``times`` stems.
    A stem is a sure sign if the share of other documents that have it is at most ``doubt`` of that of toxic ones.
    """

    per_class: int = 1500
    max_chars: int = 20_000
    shortest: int = 3
    longest: int = 10
    occurrences: int = 3
    times: int = 3
    fewest: int = 3
    doubt: float = 0.02
    penalty: float = 1.0
    seed: int = 5


@dataclass(frozen=True)
class Model:
    words: Lexicon
    weights: np.ndarray
    bias: float

    def log_odds(self, text: str) -> float:
        return self.bias + float(weighed(matches(text, self.words)) @ self.weights)


# Letters, whether they begin a word, and from which occurrence in a document on they count.
Stem = tuple[str, bool, int]


def _gain(a: int, n1: int, b: int, n0: int) -> float:
    """Twice the log-likelihood ratio of different shares against an equal one; 0 unless the first is larger."""
    if a * n0 <= b * n1:
        return 0.0
    share = (a + b) / (n1 + n0)

    def part(k: int, n: int) -> float:
        hit = k * math.log(k / n / share) if k else 0.0
        miss = (n - k) * math.log((n - k) / n / (1 - share)) if k < n else 0.0
        return hit + miss

    return 2 * (part(a, n1) + part(b, n0))


def learned_stems(toxic: list[str], other: list[str], settings: Settings) -> list[tuple[str, bool, bool]]:
    """Stems that newly explain the most toxic documents beyond chance, one after the other.

    The threshold grows with the number of stems there are to choose from, so that chance alone
    seldom gives one.
    """

    def stems(text: str) -> set[Stem]:
        found: Counter = Counter()
        for word, n in Counter(_WORDS.findall(text.lower())).items():
            if len(word) >= settings.shortest:
                found[word, False] += n
                for k in range(settings.shortest, min(len(word), settings.longest) + 1):
                    found[word[:k], True] += n
        return {(*s, t) for s, n in found.items() for t in range(1, min(n, settings.occurrences) + 1)}

    docs = [stems(t) for t in toxic]
    hits = Counter(s for d in docs for s in d)
    known = {s for s, n in hits.items() if n >= settings.fewest}
    against = Counter(s for t in other for s in stems(t) & known)
    n1, n0 = len(toxic), len(other)
    least = 2 * math.log(max(len(known), 1)) + 5
    good = {s for s in known if _gain(hits[s], n1, against[s], n0) > least}
    holders: dict[Stem, list[int]] = {}
    for i, d in enumerate(docs):
        for s in d & good:
            holders.setdefault(s, []).append(i)
    missing = np.full(n1, settings.times)
    chosen: list[Stem] = []
    while good:
        new = {s: int((missing[holders[s]] > 0).sum()) for s in good}
        value = {s: new[s] - 3 * against[s] * n1 / n0 for s in good}
        near = 0.97 * max(value.values())
        if near <= 0:
            break
        # Of stems that explain about as much, the first occurrence and the longest are the surest signs.
        best = max((s for s in good if value[s] >= near), key=lambda s: (-s[2], len(s[0]), not s[1], s[0]))
        good.discard(best)
        if _gain(new[best], n1, against[best], n0) <= least:
            continue
        sure = (against[best] + 0.5) / (n0 + 1) <= settings.doubt * (hits[best] + 0.5) / (n1 + 1)
        chosen.append((best[0], best[1], sure and best[2] == 1))
        # What begins with the chosen stem, or is begun by it, says the same again.
        good = {s for s in good if not (s[0].startswith(best[0]) or s[1] and best[0].startswith(s[0]))}
        missing[holders[best]] -= 1
    return chosen


def fit(texts: list[str], labels: np.ndarray, share: float, settings: Settings = Settings()) -> Model:
    """Learn stems and weights; ``share`` is that of toxic documents among all labelled rows."""
    weights = np.array(list(PATTERNS.values()))
    share = min(max(share, 1e-6), 1 - 1e-6)
    prior = math.log(share / (1 - share))
    if len(set(labels.tolist())) < 2:
        return Model(lexicon(), weights, prior)
    toxic = [t for t, y in zip(texts, labels) if y]
    words = lexicon(learned_stems(toxic, [t for t, y in zip(texts, labels) if not y], settings))
    rows = weighed(np.array([matches(t, words) for t in texts]))
    rows = np.hstack([rows, np.ones((len(rows), 1))])
    centre = np.append(weights, -2.0)

    def loss(w: np.ndarray) -> float:
        odds = rows @ w
        return float(np.logaddexp(0, np.where(labels == 1, -odds, odds)).sum() + settings.penalty / 2 * ((w - centre) ** 2).sum())

    now = centre.copy()
    for _ in range(100):
        chance = np.exp(-np.logaddexp(0, -rows @ now))
        slope = rows.T @ (chance - labels) + settings.penalty * (now - centre)
        curve = (rows * (chance * (1 - chance))[:, None]).T @ rows + settings.penalty * np.eye(len(now))
        step = np.linalg.solve(curve, slope)
        while loss(now - step) > loss(now) and np.abs(step).max() > 1e-9:
            step /= 2
        now = now - step
        if np.abs(step).max() < 1e-9:
            break
    # The sample holds the classes in other shares than the table does.
    taken = labels.mean()
    return Model(words, now[:-1], float(now[-1]) + prior - math.log(taken / (1 - taken)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """Fit to the documents that ``labels`` (id, ``label`` 0 or 1) names; see :class:`Settings`."""
    most = (settings.per_class, settings.max_chars, settings.seed)
    return fit(*training_rows(docs, labels, label, *most, id_col, text_col), settings)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``score``: how likely a document is toxic, between 0 and 1, for every row of ``docs``."""
    texts = plain(docs, id_col, text_col)
    shared = Shared(docs.sparkSession, model)

    def run(batches):
        for batch in batches:
            odds = np.array([shared.value.log_odds(t) for t in batch.column(1).to_pylist()], float)
            found = pa.array(np.round(1 / (1 + np.exp(-odds)), 9))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["doc_id", "score"])

    return by_texts(texts, run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, score double")

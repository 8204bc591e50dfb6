"""Personal data: fixed patterns, and a skip-chain conditional random field that adds to them.

The patterns find e-mail addresses, IP addresses, card numbers and phone numbers.  The field
labels every word with a digit or an ``@``; any other word is outside.  Neighbouring words are
tied by a chain potential, and words that occur again in the document, or that share their last
seven digits or the part before the ``@``, are tied by skip potentials, however far apart they
are.  Loopy message passing then gives each word its label probabilities, so a clear mention
also labels an unclear one.  Weights are trained by pseudo-likelihood on the patterns' own
findings in a bounded sample of documents, around prior weights.

Spans are (kind, start, end) in code points, end exclusive.  The field's spans are added where
they touch no span of a pattern; spans of the patterns always stay.

Defined results: a null or empty text has no spans; rows with a null or repeated id, and equal
rows, are each looked at alone; an empty table gives an empty result and leaves the prior
weights; very long texts are scanned in linear time.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankmatch.llm.common import Shared, by_texts, column, free_name, plain, small_batches
from rankmatch.session import store

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# The patterns.  What can be matched one way only is matched possessively, and an address is
# found from its "@", so that a text is scanned in linear time.
_AFTER_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_BLANKS = " \t\n\v\f\r"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _small(number: str) -> bool:
    number = number.lstrip("0")
    return len(number) <= 3 and int(number or "0") <= 255


def pattern_spans(text: str) -> tuple[list[Span], bool]:
    """Spans of the patterns, and whether a match was dropped because it holds too many digits."""
    found: list[Span] = []
    crowded = False
    end = at = 0
    while (at := text.find("@", at)) >= 0:
        if match := _AFTER_AT.match(text, at):
            before = text[max(end, text.rfind("@", end, at) + 1) : at]
            local = len(before) - len(before.rstrip(_LOCAL))
            if local:
                end = match.end()
                found.append(("email", at - local, end))
        at = max(at + 1, end)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(map(_small, m[0].split("."))):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if len(m[0]) >= 12:
                digits = _digits(m[0])
                crowded |= len(digits) > 19
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            digits = len(_digits(m[0]))
            crowded |= digits > 15
            if 9 <= digits <= 15:
                found.append(("phone", *m.span()))
    return ordered(found), crowded


def ordered(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: Iterable[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


# Labels of the field: outside, and the kinds; a card or phone number may go over several words.
LABELS = ("O", "email", "ip", "card", "card+", "phone", "phone+")
_KIND = np.array([0, 1, 2, 3, 3, 4, 4])
_FIRST = {"email": 1, "ip": 2, "card": 3, "phone": 5}
_NEXT = {"email": 1, "ip": 2, "card": 4, "phone": 6}

# Words before a number that tell what it is, by kind: fixed values.
CUES = {
    "phone": ("phone", "tel", "telephone", "call", "mobile", "fax", "telefon", "telefono", "teléfono", "téléphone"),
    "card": ("card", "visa", "mastercard", "karte", "carte", "tarjeta"),
    "ip": ("ip", "host", "server", "address"),
    "email": ("email", "e-mail", "mail", "correo", "courriel"),
}
_CUE = {word: kind for kind, words in CUES.items() for word in words}

_EVIDENCE = re.compile(r"[0-9@][^ \t\n\v\f\r]*")
_LEADING = re.compile(r"[^A-Za-z0-9+(]+")
_QUAD = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_MAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_GROUPS = re.compile(r"[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}|\([0-9]{3}\)[0-9]{3}-[0-9]{4}")
_PAIR = re.compile(r"[0-9]{3}[-.][0-9]{4}")

FEATURES = (
    "bias", "mail", "at", "quad", "wide quad", "digits", "code", "plus", "bracket", "groups", "pair", "four",
    "1-2", "3-4", "5-8", "9-11", "12-19 luhn", "12-19", "20 or more", "letters", "dot",
    "after", "run of fours", "in run of fours", "phone cue", "card cue", "ip cue", "email cue",
)
_BIT = {name: 1 << i for i, name in enumerate(FEATURES)}
CHAIN, SAME, ALIKE = range(3)


@dataclass
class Graph:
    """The words of one document that the field labels: (start, end), features and ties."""

    words: list[tuple[int, int]]
    bits: list[int]
    ties: list[tuple[int, int, int]]


def _describe(core: str, digits: str) -> int:
    bits = _BIT["bias"]
    n = len(digits)
    if "@" in core:
        bits |= _BIT["mail" if _MAIL.fullmatch(core) else "at"]
    if _QUAD.fullmatch(core):
        bits |= _BIT["quad" if all(map(_small, core.split("."))) else "wide quad"]
    if n == len(core):
        bits |= _BIT["digits"]
        if n == 4:
            bits |= _BIT["four"]
    if core[0] == "+":
        bits |= _BIT["code" if n <= 3 and n == len(core) - 1 else "plus"]
    if core[0] == "(" and core[-1] == ")" and n == len(core) - 2:
        bits |= _BIT["bracket"]
    if _GROUPS.fullmatch(core):
        bits |= _BIT["groups"]
    if _PAIR.fullmatch(core):
        bits |= _BIT["pair"]
    if n:
        sizes = ((2, "1-2"), (4, "3-4"), (8, "5-8"), (11, "9-11"), (19, "12-19"))
        size = next((name for most, name in sizes if n <= most), "20 or more")
        bits |= _BIT["12-19 luhn" if size == "12-19" and luhn(digits) else size]
    if any(c.isalpha() for c in core):
        bits |= _BIT["letters"]
    if "." in core:
        bits |= _BIT["dot"]
    return bits


def graph(text: str) -> Graph | None:
    """The field over one whole text, or None if no word of it has a digit or an ``@``."""
    words, bits, cores, numbers, ties = [], [], [], [], []
    done = 0
    for m in _EVIDENCE.finditer(text):
        before = text[done : m.start()]
        cut = max(map(before.rfind, _BLANKS)) + 1
        begin, end = done + cut, m.end()
        word = text[begin:end]
        if lead := _LEADING.match(word):
            begin, word = begin + lead.end(), word[lead.end() :]
        stop = len(word)
        while stop and not (word[stop - 1].isascii() and word[stop - 1].isalnum() or word[stop - 1] == ")"):
            stop -= 1
        core, gap, done = word[:stop], before[:cut], end
        if not core:
            continue
        digits = _digits(core)
        found = _describe(core, digits)
        if words and gap == " ":
            found |= _BIT["after"]
            ties.append((len(words) - 1, len(words), CHAIN))
        if cue := gap[-40:].split()[-1:]:
            if kind := _CUE.get(cue[0].strip(".,:;()#'\"").lower()):
                found |= _BIT[f"{kind} cue"]
        words.append((begin, begin + stop))
        bits.append(found)
        cores.append(core)
        numbers.append(digits)
    if not words:
        return None
    chained = {j for _, j, _ in ties}
    for i in range(len(words) - 3):
        four = range(i, i + 4)
        if all(bits[j] & _BIT["four"] for j in four) and chained.issuperset(four[1:]):
            if luhn("".join(numbers[j] for j in four)):
                bits[i] |= _BIT["run of fours"]
                for j in four[1:]:
                    bits[j] |= _BIT["in run of fours"]
    first: dict[str, int] = {}
    last: dict[str, int] = {}
    for i, core in enumerate(cores):
        folded = core.lower()
        keys = [folded]
        if len(numbers[i]) >= 7:
            keys.append("#" + numbers[i][-7:])
        if "@" in folded:
            keys.append(folded[: folded.index("@")])
        met = set()
        for key in keys:
            for j in (last.get(key), first.get(key)):
                if j is not None and j != i and j not in met:
                    met.add(j)
                    ties.append((j, i, SAME if cores[j].lower() == folded else ALIKE))
            first.setdefault(key, i)
            last[key] = i
    return Graph(words, bits, ties)


@dataclass(frozen=True)
class Field:
    """Weights: of the features for each label, of neighbours, and of agreement across a skip tie."""

    features: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def prior() -> Field:
    """The weights before any training, and the centre of their penalty: fixed values."""
    features = np.zeros((len(FEATURES), len(LABELS)))
    for name, label, weight in (
        ("bias", "O", 3), ("mail", "email", 7), ("quad", "ip", 7), ("12-19 luhn", "card", 7),
        ("run of fours", "card", 7), ("in run of fours", "card+", 7), ("code", "phone", 2), ("bracket", "phone+", 2),
        ("pair", "phone+", 2), ("groups", "phone", 4), ("phone cue", "phone", 2), ("card cue", "card", 1),
        ("ip cue", "ip", 1), ("email cue", "email", 1), ("letters", "O", 2),
    ):
        features[FEATURES.index(name), LABELS.index(label)] = weight
    chain = np.zeros((len(LABELS), len(LABELS)))
    for a, b in (("card", "card+"), ("card+", "card+"), ("phone", "phone+"), ("phone+", "phone+")):
        chain[LABELS.index(a), LABELS.index(b)] = 2
    return Field(features, chain, np.array([1.5, 1.0]))


_TIES = 1 << 14
_AGREE = (_KIND[:, None] == _KIND[None, :]).astype(float)


def _matrix(bits: np.ndarray) -> np.ndarray:
    return (bits[:, None] >> np.arange(len(FEATURES)) & 1).astype(float)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def fit(bits: np.ndarray, labels: np.ndarray, ties: np.ndarray, steps: int = 200, penalty: float = 1.0) -> Field:
    """Maximise the pseudo-likelihood of the labels minus a squared distance from the prior weights."""
    start = prior()
    if not len(bits):
        return start
    rows = _matrix(bits)
    truth = np.eye(len(LABELS))[labels]
    a, b, kind = ties.T if len(ties) else np.zeros((3, 0), int)
    chain, skip = kind == CHAIN, kind > CHAIN
    ca, cb, sa, sb, sk = a[chain], b[chain], a[skip], b[skip], kind[skip] - 1
    values = [start.features.copy(), start.chain.copy(), start.skip.copy()]
    centre = [start.features, start.chain, start.skip]
    speed = [np.zeros_like(v) for v in values]
    size = [np.zeros_like(v) for v in values]
    for step in range(1, steps + 1):
        out = rows @ values[0]
        np.add.at(out, cb, values[1][labels[ca]])
        np.add.at(out, ca, values[1][:, labels[cb]].T)
        np.add.at(out, sb, values[2][sk, None] * _AGREE[labels[sa]])
        np.add.at(out, sa, values[2][sk, None] * _AGREE[labels[sb]])
        rest = truth - _softmax(out)
        slope = [rows.T @ rest, np.zeros_like(values[1]), np.zeros_like(values[2])]
        np.add.at(slope[1], labels[ca], rest[cb])
        np.add.at(slope[1].T, labels[cb], rest[ca])
        gain = (rest[sb] * _AGREE[labels[sa]]).sum(1) + (rest[sa] * _AGREE[labels[sb]]).sum(1)
        np.add.at(slope[2], sk, gain)
        for i in range(3):
            g = slope[i] - penalty * (values[i] - centre[i])
            speed[i] = 0.9 * speed[i] + 0.1 * g
            size[i] = 0.99 * size[i] + 0.01 * g * g
            move = speed[i] / (1 - 0.9**step) / (np.sqrt(size[i] / (1 - 0.99**step)) + 1e-9)
            values[i] += 0.05 * move
    return Field(*values)


def probabilities(bits: np.ndarray, ties: np.ndarray, field: Field, rounds: int = 10) -> np.ndarray:
    """Label probabilities of every word, by loopy message passing over all ties at once."""
    own = _matrix(bits) @ field.features
    if not len(ties):
        return _softmax(own)
    pair = np.stack([field.chain, field.skip[0] * _AGREE, field.skip[1] * _AGREE])
    both = np.concatenate([pair, pair.transpose(0, 2, 1)])
    a, b, kind = ties.T
    source, target = np.concatenate([a, b]), np.concatenate([b, a])
    weight = np.concatenate([kind, kind + 3])
    back = np.roll(np.arange(len(source)), len(a))
    message = np.zeros((len(source), len(LABELS)))
    for _ in range(rounds):
        belief = own.copy()
        np.add.at(belief, target, message)
        cavity = belief[source] - message[back]
        # A slice of the ties at a time, as every tie takes a matrix of labels.
        for k in range(0, len(source), _TIES):
            part = slice(k, k + _TIES)
            sent = cavity[part, :, None] + both[weight[part]]
            top = sent.max(axis=1)
            new = top + np.log(np.exp(sent - top[:, None, :]).sum(axis=1))
            message[part] = 0.5 * message[part] + 0.5 * (new - new.max(axis=1, keepdims=True))
    belief = own.copy()
    np.add.at(belief, target, message)
    return _softmax(belief)


def _decoded(g: Graph, chance: np.ndarray, threshold: float) -> list[Span]:
    """Words whose kind is likely enough, those of one number put together."""
    kinds = np.stack([chance[:, _KIND == k].sum(axis=1) for k in range(1, 5)], axis=1)
    best = kinds.argmax(axis=1)
    sure = kinds[np.arange(len(best)), best] >= threshold
    near = {j for _, j, t in g.ties if t == CHAIN}
    spans: list[Span] = []
    for i in np.flatnonzero(sure):
        kind, (start, end) = KINDS[best[i]], g.words[i]
        goes_on = chance[i, _NEXT[kind]] > chance[i, _FIRST[kind]]
        if goes_on and spans and i in near and sure[i - 1] and best[i - 1] == best[i]:
            start = spans.pop()[1]
        spans.append((kind, start, end))
    return spans


def added_spans(graphs: Sequence[Graph], bases: Sequence[list[Span]], field: Field, threshold: float) -> list[list[Span]]:
    """The field's spans for several documents at a time, without those that touch a pattern's span."""
    if not graphs:
        return []
    sizes = np.cumsum([0, *(len(g.words) for g in graphs)])
    bits = np.array([b for g in graphs for b in g.bits], np.int64)
    ties = np.array([(i + at, j + at, t) for g, at in zip(graphs, sizes) for i, j, t in g.ties], int).reshape(-1, 3)
    chance = probabilities(bits, ties, field)
    result = []
    for g, base, low, high in zip(graphs, bases, sizes, sizes[1:]):
        spans = _decoded(g, chance[low:high], threshold)
        taken = sorted((s, e) for _, s, e in base)
        free, k, reach = [], 0, 0
        for span in spans:
            while k < len(taken) and taken[k][0] < span[2]:
                reach = max(reach, taken[k][1])
                k += 1
            if reach <= span[1]:
                free.append(span)
        result.append(free)
    return result


def _labels(g: Graph, spans: list[Span]) -> list[int]:
    labels, k = [], 0
    ordered_spans = sorted(spans, key=lambda s: s[1])
    for start, end in g.words:
        while k < len(ordered_spans) and ordered_spans[k][2] <= start:
            k += 1
        label = 0
        if k < len(ordered_spans) and ordered_spans[k][1] < end:
            kind, first, _ = ordered_spans[k]
            label = (_FIRST if start <= first else _NEXT)[kind]
        labels.append(label)
    return labels


def train(
    docs: DataFrame,
    sample_docs: int = 20_000,
    seed: int = 11,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_words: int = 4_000_000,
) -> Field:
    """Fit the field to the patterns' findings in about ``sample_docs`` documents, chosen by a seeded hash.

    At most twice as many are taken, one row of each id.  Documents with a match of too many digits are
    left out, as nobody knows what their words are.  Only words' features and ties reach the driver, together
    at most ``max_words``: documents with over a hundredth of that are left out, and of the
    others those with the least hashes are taken.
    """
    texts = plain(docs, id_col, text_col).where("doc_id IS NOT NULL")
    share = min(1.0, sample_docs / max(texts.count(), 1))
    some = texts.withColumn("mark", F.xxhash64(F.lit(seed), "doc_id"))
    some = some.where(F.pmod("mark", F.lit(1_000_000)) < int(share * 1_000_000))

    def run(batches):
        for batch in batches:
            rows = []
            for text, at in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                g = graph(text)
                if g is not None and 100 * (len(g.bits) + len(g.ties)) <= max_words:
                    spans, crowded = pattern_spans(text)
                    if not crowded:
                        rows.append((at, g.bits, _labels(g, spans), [x for tie in g.ties for x in tie]))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(schema.names, row)) for row in rows], schema=schema
            )

    lists = pa.list_(pa.int64())
    schema = pa.schema([("mark", pa.int64()), ("bits", lists), ("labels", lists), ("ties", lists)])
    found = by_texts(some, run, "mark bigint, bits array<bigint>, labels array<bigint>, ties array<bigint>")
    one = found.groupBy("mark").agg(F.min(F.struct("bits", "labels", "ties")).alias("one"))
    held = store(one.select("mark", "one.*"), "words")
    sizes = held.select("mark", (F.size("bits") + F.size("ties") / 3).cast("long").alias("n"))
    first = sizes.orderBy("mark").limit(2 * sample_docs).collect()
    fits = np.cumsum([r.n for r in first]) <= max_words
    last = max((r.mark for r, ok in zip(first, fits) if ok), default=None)
    rows = sorted(held.where(F.col("mark") <= F.lit(last)).collect(), key=lambda r: r.mark)
    starts = np.cumsum([0, *(len(r.bits) for r in rows)])
    bits = np.array([b for r in rows for b in r.bits], np.int64)
    labels = np.array([x for r in rows for x in r.labels], int)
    ties = [np.array(r.ties, int).reshape(-1, 3) + [s, s, 0] for r, s in zip(rows, starts)]
    return fit(bits, labels, np.concatenate([np.zeros((0, 3), int), *ties]))


def find(texts: Sequence[str], field: Field, threshold: float = 0.95) -> list[tuple[list[Span], list[Span]]]:
    """Spans of the patterns and all spans, for every one of some texts."""
    bases = [pattern_spans(t)[0] for t in texts]
    graphs = [(i, g) for i, t in enumerate(texts) if (g := graph(t)) is not None]
    more = added_spans([g for _, g in graphs], [bases[i] for i, _ in graphs], field, threshold)
    added = {i: spans for (i, _), spans in zip(graphs, more)}
    return [(base, ordered([*base, *added.get(i, [])])) for i, base in enumerate(bases)]


def scan(
    docs: DataFrame, field: Field, threshold: float = 0.95, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, ``base`` and ``spans``: arrays of (kind, start, end) for every row of ``docs``."""
    texts = plain(docs, id_col, text_col)
    shared = Shared(docs.sparkSession, field)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            found = find(batch.column(1).to_pylist(), shared.value, threshold)
            sides = [
                pa.array([[dict(zip(("kind", "start", "end"), s)) for s in f[k]] for f in found], span) for k in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *sides], names=["doc_id", "base", "spans"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    array = "array<struct<kind:string,start:bigint,end:bigint>>"
    return by_texts(texts, run, f"doc_id {kind}, base {array}, spans {array}")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with a mark such as ``<EMAIL>`` in place of each span; spans that overlap get one mark."""
    parts, done = [], 0
    for kind, start, end in spans:
        if start >= done:
            parts += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join(parts) + text[done:]


def redact(
    docs: DataFrame,
    field: Field,
    threshold: float = 0.95,
    text_col: str = "text",
    chars_col: str | None = "n_chars",
) -> DataFrame:
    """``docs`` with personal data replaced in the text; ``chars_col``, if there is one, is counted anew."""
    shared = Shared(docs.sparkSession, field)
    name = free_name(docs.columns, "__redacted")

    def run(batches):
        for batch in batches:
            at = batch.schema.names.index(text_col)
            texts = batch.column(at).to_pylist()
            found = find([t or "" for t in texts], shared.value, threshold)
            new = [t if t is None else redacted(t, spans) for t, (_, spans) in zip(texts, found)]
            columns = [*batch.columns, pa.array(new, batch.schema.field(at).type)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, name])

    small_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.StringType())])
    done = docs.mapInArrow(run, schema)
    fresh = {text_col: column(name)}
    if chars_col in docs.columns:
        counted = F.length(column(name)).cast(docs.schema[chars_col].dataType)
        fresh[chars_col] = F.when(column(text_col).eqNullSafe(column(name)), column(chars_col)).otherwise(counted)
    return done.select(*[fresh.get(c, column(c)).alias(c) for c in docs.columns])

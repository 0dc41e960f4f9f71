"""Personal data by fixed patterns and a linear-chain conditional random field.

The base spans are plain patterns for e-mail addresses, IP addresses, payment cards and phone
numbers. A linear-chain CRF over word-shape features adds forms that the patterns miss: spelt-out
e-mail addresses, phone numbers without a plus sign, cards with other separators. It is trained
on the driver from a small labelled table (at most `TABLE_ROWS` sentences, generated by rule from
the templates below unless the caller brings one) and decoded by Viterbi in numpy batches. A
decoded span counts only if it is valid for its kind and overlaps no base span.

The whole of every text is scanned. A sequence is a maximal run of words within `REACH` words of
one that holds a digit, an @, or a spelt-out "dot" or "(at)"; all such runs are decoded.

Spans are offsets of code points, end exclusive. Defined results: a null or empty text has no
spans. Equal starts are listed by kind, in the order of `KINDS`, then by end. Repeated rows each
get the same result; other columns, null or not, are kept as they are; an empty table gives an
empty one. Work is linear in the length of a text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from orderloom.llm.common import bounded_batches, share, shared_value, ship, table

ship(__name__)

KINDS = ("email", "ip", "card", "phone")
REACH = 4
TABLE_ROWS = 10_000
FEATURES = 1 << 12
# Numbers in one padded batch of the decoder.
CELLS = 2_000_000

# ---- base spans ------------------------------------------------------------------------------

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is entered at its first digit only: later entries cannot match if that fails.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def valid_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def email_spans(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards so that long words cost no retries."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted."""
    out = [(s, 0, e) for s, e in email_spans(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if valid_ip(m.group())]
    for m in _CARD.finditer(text):
        digits = digits_of(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(digits_of(m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


# ---- the labelled table ----------------------------------------------------------------------

# {} takes a value of the kind; each value is split at spaces and labelled word by word.
TEMPLATES = {
    "email": ["mail {} for details", "contact {}", "write to {} today", "{} answers", "the {} of"],
    "phone": ["call {} now", "phone {}", "tel. {} or", "ring {} and ask", "the {} of"],
    "card": ["card {} was charged", "pay with {}", "number {} expires", "the {} of"],
    "": [
        "in {} the", "page {} of", "about {} people", "version {} was", "token = {}",
        "on {} they", "at {} and", "no. {} is", "the {} of", "the dot {} was",
    ],
}


def labelled_table(rows_each: int = 60, seed: int = 5) -> list[tuple[list[str], list[str]]]:
    """Sentences of words and labels (O, B-kind, I-kind), made by rule."""
    rng = np.random.default_rng(seed)

    def digits(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    def word() -> str:
        return "".join(rng.choice(list("abcdefghilmnoprstuvw"), rng.integers(2, 9)))

    def one(options: list[str]) -> str:
        return options[rng.integers(len(options))]

    def value(kind: str) -> str:
        a, b, c, d, e = digits(3), digits(3), digits(4), digits(4), digits(4)
        if kind == "email":
            at, dot = one(["(at)", "[at]", "at"]), one(["(dot)", "[dot]", "dot"])
            return f"{word()} {at} {word()} {dot} {one(['com', 'org', 'net', 'de'])}"
        if kind == "phone":
            return one([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a} {b} {c}", f"{a}.{b}.{c}"])
        if kind == "card":
            sep = one([".", "/", "_"])
            return sep.join([c, d, e, digits(4)])
        return one([
            digits(4), digits(rng.integers(1, 4)), f"20{digits(2)}-0{digits(1)}-1{digits(1)}",
            f"{digits(1)}.{digits(1)}", f"{digits(2)}:{digits(2)}", f"${digits(3)}",
            digits(rng.integers(5, 19)), "".join(rng.choice(list("0123456789abcdef"), 24)), word(),
            f"{digits(3)} {word()} {digits(2)}",
        ])

    table_rows = []
    for kind, templates in TEMPLATES.items():
        for _ in range(rows_each * (3 if kind == "" else 1)):
            words, labels = [], []
            for part in one(templates).split():
                if part != "{}":
                    words.append(part)
                    labels.append("O")
                    continue
                for i, w in enumerate(value(kind).split()):
                    words.append(w)
                    labels.append("O" if kind == "" else f"{'I' if i else 'B'}-{kind}")
            pad = [word() for _ in range(rng.integers(0, 4))]
            tail = [word() for _ in range(rng.integers(0, 4))]
            if words and rng.random() < 0.3:
                words[-1] += one([".", ",", ";"])
            table_rows.append(
                (pad + words + tail, ["O"] * len(pad) + labels + ["O"] * len(tail))
            )
    return table_rows


# ---- the model -------------------------------------------------------------------------------

LABELS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
_CUES = frozenset("at dot com org net de phone tel call ring mail email card pay number".split())


def shape(word: str) -> str:
    """Letters as x or X, digits as d with runs of up to four kept, other marks as they are."""
    out, last, run = [], "", 0
    for c in word:
        k = "d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c
        run = run + 1 if k == last else 1
        last = k
        if run <= (4 if k == "d" else 1):
            out.append(k)
    return "".join(out)


# Features of words seen lately. A wrapped function would be pickled by its name alone, which
# workers without the package cannot find.
_KNOWN: dict[str, tuple[int, ...]] = {}


def features(word: str) -> tuple[int, ...]:
    found = _KNOWN.get(word)
    if found is None:
        if len(_KNOWN) >= 1 << 16:
            _KNOWN.clear()
        found = _KNOWN[word] = _features(word)
    return found


def _features(word: str) -> tuple[int, ...]:
    bare = word.strip(".,;:!?")
    form = shape(bare)
    n = sum(c.isdigit() for c in bare)
    names = [f"s={form}", f"n={min(n, 20)}", f"m={''.join(sorted(set(form)))}", "b"]
    if bare.lower().strip("()[]") in _CUES:
        names.append(f"w={bare.lower()}")
    return tuple(
        int.from_bytes(hashlib.blake2b(x.encode(), digest_size=4).digest()) % FEATURES
        for x in names
    )


class Crf:
    """Weights of a word's, its left and its right neighbour's features, and of transitions."""

    def __init__(self) -> None:
        k = len(LABELS)
        self.emit = np.zeros((3, FEATURES + 1, k))
        self.move = np.zeros((k + 1, k))  # the last row starts a sequence

    @staticmethod
    def ids(sentences: list[list[str]]) -> list[list[tuple[int, ...]]]:
        return [[features(w) for w in s] for s in sentences]

    def scores(self, sentences: list[list[str]]) -> list[np.ndarray]:
        """Emission scores [words, labels] of each sentence."""
        words = sorted({w for s in sentences for w in s})
        at = {w: i for i, w in enumerate(words)}
        base = np.stack([self.emit[:, list(features(w))].sum(1) for w in words], axis=1)
        edge = self.emit[:, FEATURES]
        out = []
        for s in sentences:
            i = np.array([at[w] for w in s])
            e = base[0, i].copy()
            e[1:] += base[1, i[:-1]]
            e[:-1] += base[2, i[1:]]
            e[0] += edge[1]
            e[-1] += edge[2]
            out.append(e)
        return out

    def decode(self, sentences: list[list[str]]) -> list[np.ndarray]:
        """Best labels of each sentence: Viterbi over padded batches of like lengths."""
        out: list = [None] * len(sentences)
        order = sorted(range(len(sentences)), key=lambda i: len(sentences[i]))
        lo = 0
        while lo < len(order):
            hi = lo + 1
            while hi < len(order) and (hi + 1 - lo) * len(sentences[order[hi]]) <= CELLS // len(LABELS):
                hi += 1
            part = order[lo:hi]
            lens = np.array([len(sentences[i]) for i in part])
            e = np.zeros((len(part), lens.max(), len(LABELS)))
            for row, s in zip(e, self.scores([sentences[i] for i in part])):
                row[: len(s)] = s
            best = e[:, 0] + self.move[-1]
            back = np.zeros(e.shape, np.int8)
            final = best.copy()
            for t in range(1, e.shape[1]):
                step = best[:, :, None] + self.move[None, :-1]
                back[:, t] = step.argmax(1)
                best = step.max(1) + e[:, t]
                ends = lens == t + 1
                final[ends] = best[ends]
            label = final.argmax(1)
            path = np.zeros(e.shape[:2], np.int8)
            rows = np.arange(len(part))
            for t in range(e.shape[1] - 1, -1, -1):
                inside = t < lens
                path[inside, t] = label[inside]
                label = np.where(inside, back[rows, t, label], label)
            for i, p, n in zip(part, path, lens):
                out[i] = p[:n]
            lo = hi
        return out


def _forward_backward(e, lens, move):
    """Label and transition marginals of padded sentences."""
    n, t_max, k = e.shape
    valid = np.arange(t_max)[None, :] < lens[:, None]

    def lse(x, axis):
        top = x.max(axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)

    f, b = np.zeros_like(e), np.zeros_like(e)
    f[:, 0] = e[:, 0] + move[-1]
    for t in range(1, t_max):
        f[:, t] = lse(f[:, t - 1, :, None] + move[None, :-1], 1) + e[:, t]
    for t in range(t_max - 2, -1, -1):
        nxt = lse(move[None, :-1] + (e[:, t + 1] + b[:, t + 1])[:, None, :], 2)
        b[:, t] = np.where(valid[:, t + 1, None], nxt, 0.0)
    whole = lse(f[np.arange(n), lens - 1], 1)
    unary = np.exp(f + b - whole[:, None, None]) * valid[:, :, None]
    pair = np.exp(
        f[:, :-1, :, None] + move[None, None, :-1] + (e + b)[:, 1:, None, :]
        - whole[:, None, None, None]
    ) * valid[:, 1:, None, None]
    return unary, pair.sum((0, 1))


def train(rows: list[tuple[list[str], list[str]]], steps: int = 120, decay: float = 1e-3) -> Crf:
    """Maximum likelihood with a quadratic penalty, by Adam over the whole table."""
    if len(rows) > TABLE_ROWS:
        raise ValueError(f"the labelled table has more than {TABLE_ROWS} rows")
    model, k = Crf(), len(LABELS)
    lens = np.array([len(w) for w, _ in rows])
    t_max = lens.max()
    gold = np.zeros((len(rows), t_max), np.int64)
    place, which, feature = [], [], []
    for i, (words, labels) in enumerate(rows):
        gold[i, : len(labels)] = [LABELS.index(x) for x in labels]
        ids = [features(w) for w in words]
        for t in range(len(words)):
            near = (ids[t], ids[t - 1] if t else (FEATURES,),
                    ids[t + 1] if t + 1 < len(words) else (FEATURES,))
            for table_no, fs in enumerate(near):
                place += [i * t_max + t] * len(fs)
                which += [table_no] * len(fs)
                feature += fs
    place, slot = np.array(place), np.array(which) * (FEATURES + 1) + np.array(feature)
    used, slot = np.unique(slot, return_inverse=True)
    w, m = np.zeros((len(used), k)), np.zeros((k + 1, k))
    valid = np.arange(t_max)[None, :] < lens[:, None]
    truth = np.zeros((len(rows), t_max, k))
    np.put_along_axis(truth, gold[:, :, None], 1.0, 2)
    truth *= valid[:, :, None]
    true_move = np.zeros((k + 1, k))
    np.add.at(true_move, (gold[:, :-1][valid[:, 1:]], gold[:, 1:][valid[:, 1:]]), 1)
    np.add.at(true_move, (np.full(len(rows), k), gold[:, 0]), 1)
    state = [np.zeros_like(x) for x in (w, w, m, m)]
    for step in range(1, steps + 1):
        e = np.zeros((len(rows) * t_max, k))
        np.add.at(e, place, w[slot])
        unary, pair = _forward_backward(e.reshape(len(rows), t_max, k), lens, m)
        got = np.zeros((k + 1, k))
        got[:-1], got[-1] = pair, unary[:, 0].sum(0)
        gw = np.zeros_like(w)
        np.add.at(gw, slot, (unary - truth).reshape(-1, k)[place])
        for x, g, (i, j) in ((w, gw / len(rows), (0, 1)), (m, (got - true_move) / len(rows), (2, 3))):
            g = g + decay * x
            state[i] = 0.9 * state[i] + 0.1 * g
            state[j] = 0.99 * state[j] + 0.01 * g * g
            up = state[i] / (1 - 0.9**step)
            x -= 0.2 * up / (np.sqrt(state[j] / (1 - 0.99**step)) + 1e-6)
    model.emit.reshape(-1, k)[used] = w
    model.move = m
    return model


# ---- finding spans ---------------------------------------------------------------------------

_SPELT = re.compile(r"(?i)\bdot\b|[(\[]at[)\]]")
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def sequences(text: str) -> list[list[tuple[int, int]]]:
    """Runs of words (start, end) around words that could hold personal data."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    white = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    edge = np.diff(np.r_[True, white, True].astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    hits = np.flatnonzero(((points >= 48) & (points <= 57)) | (points == 64))
    spelt = [m.start() for m in _SPELT.finditer(text)]
    if spelt:
        hits = np.union1d(hits, spelt)
    if len(hits) == 0:
        return []
    words = np.unique(np.searchsorted(starts, hits, side="right") - 1)
    cut = np.flatnonzero(np.diff(words) > 2 * REACH) + 1
    out = []
    for run in np.split(words, cut):
        lo, hi = max(0, run[0] - REACH), min(len(starts), run[-1] + REACH + 1)
        out.append(list(zip(starts[lo:hi].tolist(), ends[lo:hi].tolist())))
    return out


def _valid(kind: int, text: str) -> bool:
    digits = digits_of(text)
    if kind == 0:
        low = text.lower()
        return ("dot" in low.split() or "(dot)" in low or "[dot]" in low or "." in low) and bool(
            re.search(r"@|(^|[\s(\[])at([\s)\]]|$)", low)
        )
    if kind == 1:
        return text.count(".") == 3 and text.replace(".", "").isdigit() and valid_ip(text)
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[A-Za-z]", text)
    return 9 <= len(digits) <= 15 and not re.search(r"[^0-9().\s/-]", text)


def crf_spans(texts: list[str], model: Crf, base: list[list[tuple[int, int, int]]]):
    """For each text the decoded spans (start, kind, end) that are valid and touch no base span."""
    owner, runs = [], []
    for i, text in enumerate(texts):
        for run in sequences(text):
            owner.append(i)
            runs.append(run)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not runs:
        return out
    paths = model.decode([[texts[i][s:e] for s, e in run] for i, run in zip(owner, runs)])
    for i, run, path in zip(owner, runs, paths):
        if not path.any():
            continue
        t = 0
        while t < len(path):
            kind, begin = (path[t] - 1) // 2, t
            t += 1
            if path[begin] == 0:
                continue
            while t < len(path) and path[t] == 2 * kind + 2:
                t += 1
            start, end = run[begin][0], run[t - 1][1]
            found = texts[i][start:end]
            while found and found[-1] in ".,;:!?":
                found, end = found[:-1], end - 1
            clear = all(end <= s or e <= start for s, _, e in base[i])
            if clear and _valid(int(kind), found):
                out[i].append((start, int(kind), end))
    return out


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, or union of spans that overlap, replaced by its first kind."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, kind, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join(out) + text[at:]


FOUND = [StructField(f"n_{k}", LongType()) for k in KINDS] + [
    StructField("base_sha256", StringType()),
    StructField("spans", StringType()),
]


def find(docs: DataFrame, model: Crf | None = None, mask: bool = False) -> DataFrame:
    """`docs` with the counts and digest of base spans and all spans; mask: text is replaced."""
    bounded_batches(docs.sparkSession)
    model = model or train(labelled_table())
    shared = share(docs.sparkSession, model)
    names = {f.name for f in FOUND}
    kept = [f for f in docs.schema.fields if f.name not in names]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            worth = pc.match_substring_regex(column, r"(?i)[0-9@]|\bdot\b|[(\[]at[)\]]")
            rows = np.flatnonzero(np.asarray(pc.fill_null(worth, False).cast(pa.uint8())))
            empty = hashlib.sha256(b"").hexdigest()
            counts = np.zeros((len(KINDS), len(column)), np.int64)
            digest, spans = [empty] * len(column), [""] * len(column)
            changed: dict[int, str] = {}
            for lo in range(0, len(rows), 512):
                part = rows[lo : lo + 512]
                texts = column.take(pa.array(part)).to_pylist()
                base = [base_spans(t) for t in texts]
                more = crf_spans(texts, shared_value(shared), base)
                for i, text, b, m in zip(part.tolist(), texts, base, more):
                    for _, kind, _ in b:
                        counts[kind, i] += 1
                    digest[i] = hashlib.sha256(listed(b).encode()).hexdigest() if b else empty
                    spans[i] = listed(sorted(b + m))
                    if mask and (b or m):
                        changed[i] = masked(text, sorted(b + m))
            columns = [batch.column(f.name) for f in kept]
            if changed:
                at = [f.name for f in kept].index("text")
                values = column.to_pylist()
                for i, text in changed.items():
                    values[i] = text
                columns[at] = pa.array(values, column.type)
            columns += [pa.array(c) for c in counts] + [pa.array(digest), pa.array(spans)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept + FOUND])

    return docs.select(*[f.name for f in kept]).mapInArrow(scan, StructType(kept + FOUND))


def op4_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")

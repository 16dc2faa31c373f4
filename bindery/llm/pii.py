"""Personal data: fixed patterns, and a linear-chain CRF over word shapes beside them.

The CRF labels runs of tokens that hold a digit or an @; any other token can only
be "O" (outside), which cuts the chain, so that decoding each run alone is exact.
It is trained by maximum likelihood on a small labelled table of token sequences
and decoded by Viterbi over numpy batches of runs. It adds spans where no pattern
found one: keys and passwords, and data that the patterns miss, such as two
card numbers side by side. Spans that fail their kind's check are dropped.

Defined cases: null texts count as empty and have no spans; repeated rows are
searched each; spans of different kinds may overlap; of label paths of equal score
the one with the lower label numbers wins, from the end backwards; very long texts
are searched whole; an empty table gives an empty result; other columns are kept
by found() and redacted(), but for those named pii_counts, pii_base, pii_spans,
pii_text and pii_n, which their own replace.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from contextlib import nullcontext
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from .vectext import with_fields

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
LABELS = ("O", *KINDS)
Span = tuple[int, int, int]  # start, kind's number, end

DIGITS = re.compile("[0-9]+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SPACES = " \t\n\r\x0b\x0c"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        if i % 2:
            x = 2 * x - 9 if x > 4 else 2 * x
        total += x
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def is_card(text: str) -> bool:
    d = digits_of(text)
    return 14 <= len(d) <= 19 and luhn(d)


def is_ip(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(DIGITS.fullmatch(p) and len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def base_spans(text: str, runs: list[tuple[int, int]]) -> list[Span]:
    """The four patterns' leftmost non-overlapping matches that pass their checks; runs are the text's runs of digits.

    A match of ip or card starts with a run, one of email where the characters
    before an @ begin, so that no start is tried twice and long runs stay cheap.
    """
    spans, done, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        if begin < at and (m := DOMAIN.match(text, at + 1)):
            spans.append((begin, 0, m.end()))
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)
    for kind, match, ok in ((1, IP.match, is_ip), (2, CARD.match, is_card)):
        done = 0
        for a, b in runs:
            if a >= done and (kind == 2 or text[b : b + 1] == ".") and (m := match(text, a)):
                done = m.end()
                if ok(m[0]):
                    spans.append((a, kind, done))
    if "+" in text:
        spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return sorted(spans)


class Token(NamedTuple):
    start: int
    text: str
    before: str


def token_runs(text: str, runs: list[tuple[int, int]]) -> list[list[Token]]:
    """Runs of neighbouring tokens with a digit or an @, without the marks around them, with the word before each."""
    spots = [a for a, _ in runs]
    at = text.find("@")
    while at >= 0:
        spots.append(at)
        at = text.find("@", at + 1)
    out: list[list[Token]] = []
    last = 0
    for spot in sorted(spots):
        if spot < last:
            continue
        begin = spot
        while begin > 0 and not text[begin - 1].isspace():
            begin -= 1
        end = spot
        while end < len(text) and not text[end].isspace():
            end += 1
        a, b = begin, end
        while a < b and not (text[a].isalnum() or text[a] in "+("):
            a += 1
        while b > a and not (text[b - 1].isalnum() or text[b - 1] == ")"):
            b -= 1
        joined = bool(out) and not text[last:begin].strip()
        before = out[-1][-1].text if joined else " ".join(text[max(0, begin - 40) : begin].split()[-2:])
        token = Token(a, text[a:b], before)
        if joined:
            out[-1].append(token)
        else:
            out.append([token])
        last = end
    return out


def bucket(n: int) -> str:
    return str(n) if n < 5 else "5-7" if n < 8 else "8-13" if n < 14 else "14-19" if n < 20 else "20+"


def word_shape(word: str) -> tuple[str, str]:
    """The shape with the lengths of its runs, and without."""
    kinds = "".join("9" if "0" <= c <= "9" else "A" if c.isupper() else "a" if c.isalpha() else c for c in word[:80])
    runs = re.findall(r"9+|A+|a+|.", kinds, re.S)
    return "".join(r[0] + bucket(len(r)) if r[0] in "9Aa" else r for r in runs), "".join(r[0] for r in runs)


def token_features(t: Token) -> list[str]:
    full, short = word_shape(t.text)
    d = digits_of(t.text)
    hexed = len(t.text) >= 16 and all(c in "0123456789abcdefABCDEF" for c in t.text) and not t.text.isdigit()
    cue = t.before.lower().strip(" =:\"'")
    return [
        "bias", f"full={full}", f"short={short[:24]}", f"digits={bucket(len(d))}", f"at={'@' in t.text}", f"dots={bucket(t.text.count('.'))}",
        f"hex={hexed}", f"luhn={14 <= len(d) <= 19 and luhn(d)}", f"ip={is_ip(t.text)}", f"first={t.text[:1] if not t.text[:1].isalnum() else ''}",
        f"assigned={t.before.rstrip().endswith(('=', ':'))}", f"cue={cue.split()[-1] if cue.split() else ''}",
    ]


class Model(NamedTuple):
    index: dict[str, int]
    emit: np.ndarray  # features x labels; the last row is zero, for unknown features
    move: np.ndarray  # label to label
    begin: np.ndarray


def batch(runs: list[list[list[int]]], n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """(runs x steps x features, lengths), padded with the unknown feature."""
    length = np.array([len(r) for r in runs])
    wide = max((len(f) for r in runs for f in r), default=1)
    x = np.full((len(runs), int(length.max(initial=1)), wide), n_features, dtype=np.int64)
    for i, r in enumerate(runs):
        for j, f in enumerate(r):
            x[i, j, : len(f)] = f
    return x, length


def viterbi(model: Model, x: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The best label sequence of each run (runs x steps)."""
    n, steps = x.shape[:2]
    score = model.begin + model.emit[x[:, 0]].sum(axis=1)
    back = np.zeros((n, steps, len(LABELS)), dtype=np.int8)
    for t in range(1, steps):
        through = score[:, :, None] + model.move
        back[:, t] = through.argmax(axis=1)
        moved = through.max(axis=1) + model.emit[x[:, t]].sum(axis=1)
        live = (length > t)[:, None]
        back[:, t] = np.where(live, back[:, t], np.arange(len(LABELS)))
        score = np.where(live, moved, score)
    best = np.zeros((n, steps), dtype=np.int64)
    best[:, -1] = score.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        best[:, t - 1] = back[np.arange(n), t, best[:, t]]
    return best


def fit_rows(tokens: list[list[str]], labels: list[list[str]], steps: int = 150, l2: float = 0.02) -> Model:
    """Gradient ascent on the log-likelihood, by forward and backward sums over all sequences at once."""
    runs, golds = [], []
    for words, tags in zip(tokens, labels):
        text = " ".join(words)
        starts = np.cumsum([0] + [len(w) + 1 for w in words])
        for run in token_runs(text, [m.span() for m in DIGITS.finditer(text)]):
            runs.append(run)
            golds.append([LABELS.index(tags[int(np.searchsorted(starts, t.start, side="right")) - 1]) for t in run])
    named = [[token_features(t) for t in run] for run in runs]
    index = {f: i for i, f in enumerate(sorted({f for r in named for t in r for f in t}))}
    x, length = batch([[[index[f] for f in t] for t in r] for r in named], len(index))
    n, steps_in, size = x.shape[0], x.shape[1], len(LABELS)
    gold = np.zeros((n, steps_in), dtype=np.int64)
    for i, g in enumerate(golds):
        gold[i, : len(g)] = g
    live = np.arange(steps_in) < length[:, None]
    emit, move, begin = np.zeros((len(index) + 1, size)), np.zeros((size, size)), np.zeros(size)
    velocity = [np.zeros_like(p) for p in (emit, move, begin)]
    for _ in range(steps):
        e = emit[x].sum(axis=2)
        forward = np.zeros((n, steps_in, size))
        forward[:, 0] = begin + e[:, 0]
        for t in range(1, steps_in):
            through = np.logaddexp.reduce(forward[:, t - 1, :, None] + move, axis=1) + e[:, t]
            forward[:, t] = np.where(live[:, t, None], through, forward[:, t - 1])
        backward = np.zeros((n, steps_in, size))
        for t in range(steps_in - 2, -1, -1):
            through = np.logaddexp.reduce(move[None] + (e[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(live[:, t + 1, None], through, 0)
        z = np.logaddexp.reduce(forward[:, -1], axis=1)
        p = np.exp(forward + backward - z[:, None, None]) * live[:, :, None]
        d = (np.eye(size)[gold] * live[:, :, None] - p) / n
        g_emit = np.zeros_like(emit)
        np.add.at(g_emit, x.reshape(-1, x.shape[2]), d.reshape(-1, 1, size))
        g_move = np.zeros_like(move)
        for t in range(1, steps_in):
            both = np.exp(forward[:, t - 1, :, None] + move + (e[:, t] + backward[:, t])[:, None, :] - z[:, None, None]) * live[:, t, None, None]
            g_move -= both.sum(axis=0) / n
            np.add.at(g_move, (gold[live[:, t], t - 1], gold[live[:, t], t]), 1 / n)
        for p_, g, v in zip((emit, move, begin), (g_emit, g_move, d[:, 0].sum(axis=0)), velocity):
            v *= 0.9
            v += g - l2 * p_ / max(n, 1)
            p_ += 0.8 * v
        emit[-1] = 0
    return Model(index, emit, move, begin)


def training_table(spark: SparkSession, rows: int = 400, seed: int = 7) -> DataFrame:
    """The small labelled table: invented sentences, as tokens and labels, made by a seeded generator."""
    r = random.Random(seed)
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    plain = "the order was sent to a reader in may and page two of this book on call from bob at le la und der que con".split()

    def card() -> str:
        body = r.choice("3456") + digits(r.choice((14, 14, 14, 13)))
        return body + next(c for c in "0123456789" if luhn(body + c))

    def no_card() -> str:
        body = card()
        return body[:-1] + str((int(body[-1]) + r.randint(1, 9)) % 10)

    email = lambda: f"{r.choice(plain)}.{digits(2)}@{r.choice(('mail', 'post'))}{digits(1)}.{r.choice(('example', 'test'))}.{r.choice(('com', 'org'))}"
    ip = lambda: ".".join(str(r.randint(0, 255)) for _ in range(4))
    secret = lambda: "".join(r.choice("0123456789abcdef") for _ in range(r.choice((32, 40, 40, 64))))
    phone = lambda: r.choice(([f"+{r.randint(1, 99)}", f"({digits(3)})", f"{digits(3)}-{digits(4)}"], [f"+{r.randint(1, 9)}-{digits(3)}-{digits(3)}-{digits(4)}"], [f"({digits(3)})", f"{digits(3)}-{digits(4)}"]))
    other = lambda: r.choice((digits(r.randint(1, 4)), f"{digits(1)}.{digits(2)}", f"{digits(2)}:{digits(2)}", f"19{digits(2)}-0{r.randint(1, 9)}-1{digits(1)}", f"v{digits(1)}.{digits(1)}.{digits(1)}", f"{digits(3)}%", f"p.{digits(2)}", f"{r.randint(256, 999)}.{digits(3)}.{digits(2)}.{digits(3)}", no_card(), f"@{r.choice(plain)}", f"x{digits(2)}", digits(6), digits(12), digits(24)))
    made = {"email": lambda: [email()], "ip": lambda: [ip()], "card": lambda: [card()], "phone": phone, "secret": lambda: [secret()], "O": lambda: [other()]}
    table = []
    for _ in range(rows):
        tokens, labels = [], []
        for _ in range(r.randint(1, 3)):
            for w in r.choices(plain, k=r.randint(0, 4)):
                tokens.append(w)
                labels.append("O")
            kind = r.choice((*KINDS, "O", "O"))
            if kind == "secret":
                for w in (r.choice(("token", "password", "key", "secret")), r.choice(("=", ":"))):
                    tokens.append(w)
                    labels.append("O")
            for _ in range(2 if kind == "card" and r.random() < 0.2 else 1):
                for w in made[kind]():
                    tokens.append(f'"{w}"' if kind == "secret" and r.random() < 0.7 else w + r.choice(("", "", "", ".", ",", "###")))
                    labels.append(kind)
        table.append((tokens, labels))
    return spark.createDataFrame(table, "tokens array<string>, labels array<string>")




def fit(labelled: DataFrame, most: int = 5000) -> Model:
    """A model from a labelled table of at most `most` rows, which is a bound on the sample."""
    rows = labelled.select("tokens", "labels").limit(most).collect()
    return fit_rows([r["tokens"] for r in rows], [r["labels"] for r in rows])


def crf_spans(model: Model, runs_of: list[list[list[Token]]], most: int = 200_000) -> list[list[Span]]:
    """Spans by the CRF for each text, from its runs of tokens."""
    flat = sorted(((len(run), i, run) for i, runs in enumerate(runs_of) for run in runs), key=lambda x: x[:2])
    out: list[list[Span]] = [[] for _ in runs_of]
    begin = 0
    while begin < len(flat):
        end = begin + 1
        while end < len(flat) and (end - begin + 1) * flat[end][0] <= most:
            end += 1
        part = flat[begin:end]
        x, length = batch([[[model.index.get(f, len(model.index)) for f in token_features(t)] for t in run] for _, _, run in part], len(model.index))
        for (n, i, run), best in zip(part, viterbi(model, x, length)):
            at = 0
            while at < n:
                kind, to = int(best[at]), at + 1
                short = kind == 4 or (kind == 3 and len(digits_of(run[at].text)) < 14)  # phones, and cards in groups, take several tokens
                while short and to < n and best[to] == kind and (kind == 4 or len(digits_of(run[to].text)) < 14):
                    to += 1
                if kind:
                    out[i].append((run[at].start, kind - 1, run[to - 1].start + len(run[to - 1].text)))
                at = to
        begin = end
    return out


def passes(kind: int, text: str) -> bool:
    n = len(digits_of(text))
    return (("@" in text and "." in text), is_ip(text), is_card(text), 7 <= n <= 15, len(text) >= 16)[kind]


def all_spans(texts: list[str], model: Model) -> Iterator[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text."""
    runs_of = [[m.span() for m in DIGITS.finditer(t)] for t in texts]
    by_crf = crf_spans(model, [token_runs(t, runs) if runs or "@" in t else [] for t, runs in zip(texts, runs_of)])
    for text, runs, found in zip(texts, runs_of, by_crf):
        base = base_spans(text, runs)
        covered = sorted((a, b) for a, _, b in base)
        added, at = [], 0
        for a, kind, b in sorted(found):
            while at < len(covered) and covered[at][1] <= a:
                at += 1
            if passes(kind, text[a:b]) and not any(c < b and d > a for c, d in covered[at : at + 4]):
                added.append((a, kind, b))
        yield base, sorted(base + added)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _over_texts(docs: DataFrame, labelled: DataFrame | None, fields: str, row) -> DataFrame:
    """docs with more fields, a row of which comes from (text, base spans, all spans)."""
    ship(docs.sparkSession)
    model = fit(labelled if labelled is not None else training_table(docs.sparkSession))

    def made(texts: list[str]) -> Iterator[tuple]:
        return (row(t, base, spans) for t, (base, spans) in zip(texts, all_spans(texts, model)))

    return with_fields(docs, fields, lambda: nullcontext(made))


def found(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """docs with pii_counts (of the base kinds), pii_base and pii_spans (kind:start:end, comma-joined)."""
    row = lambda text, base, spans: ([sum(s[1] == k for s in base) for k in range(4)], joined(base), joined(spans))
    return _over_texts(docs, labelled, "pii_counts array<bigint>, pii_base string, pii_spans string", row)


def redact(text: str, spans: list[Span]) -> str:
    """text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, at = [], 0
    for a, kind, b in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind]}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """docs with pii_text, the text without its personal data (null stays null), and pii_n, the number of spans."""
    done = _over_texts(docs, labelled, "pii_text string, pii_n bigint", lambda text, base, spans: (redact(text, spans), len(spans)))
    return done.withColumn("pii_text", F.when(F.col("text").isNotNull(), F.col("pii_text")))


def op2_pii(docs: DataFrame) -> DataFrame:
    done = found(docs.select("doc_id", "text"))
    counts = [F.element_at("pii_counts", i + 1).alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)]
    return done.select("doc_id", *counts, F.sha2(F.col("pii_base").cast("binary"), 256).alias("base_sha256"), F.col("pii_spans").alias("spans"))

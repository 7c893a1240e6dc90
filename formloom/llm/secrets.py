"""Secret scans: fixed patterns, and character Markov models compared by log-likelihood ratio.

Two models of order 1 over a small alphabet are trained from labelled samples: random strings (hex, base 62,
base 64) and ordinary identifiers (words, joined in the usual cases). A token of the text is a secret when
the ratio of its likelihoods a character is above a threshold set on the samples.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The patterns of the base scan, with the least length of what counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, as those of [0-9a-f]+
MIN_ASSIGN, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "markov")

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
CLASSES = "abcdefghijklmnopqrstuvwxyz" + "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "0123456789" + "+/_=-"
SIZE = len(CLASSES) + 1  # and the start
# Words of ordinary identifiers.
WORDS = (
    "account action active address agent array batch block branch buffer build button cache call channel check child "
    "class clean client close cluster code column command commit config connect content context control copy count "
    "create cursor data date default delete detail device digest driver edit element encode end engine entry error "
    "event example export factory field file filter final find first flag folder form format frame function global "
    "graph group handle hash header height helper history host image import index input insert install instance "
    "item iterator job join key label language last layer layout length level library license limit line link list "
    "load local lock log long manager map mask match matrix max member memory menu merge message method min mode "
    "model module monitor mouse move name network next node note number object offset open option order output "
    "package page panel parse partition password path pattern payload pixel point pool position prefix print "
    "process product profile program project proxy query queue random range read record region release remote "
    "remove render replace report request reset resource response result return root route row rule sample scale "
    "schedule schema scope screen script search section select sequence server service session setting shape share "
    "signal size sort source space split stack start state status step stop store stream string style system table "
    "target task template test text thread time title token topic trace track transform tree trigger type unit "
    "update upload user valid value variable vector version view watch width window word worker write zone"
).split()


def labelled_samples(n: int = 4000, seed: int = 7) -> list[tuple[str, int]]:
    """(string, 1 if random): the samples that the models are trained on, the same on every machine."""
    rng = random.Random(seed)
    alphabets = ["0123456789abcdef", CLASSES[:62], CLASSES[:62] + "+/", CLASSES[:62] + "-_", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"]
    out = []
    for k in range(n):
        out.append(("".join(rng.choice(alphabets[k % len(alphabets)]) for _ in range(rng.randint(20, 64))), 1))
        words = [rng.choice(WORDS) for _ in range(rng.randint(3, 8))]
        style = k % 6
        name = {0: "_".join(words), 1: "-".join(words), 2: words[0] + "".join(w.title() for w in words[1:]), 3: "_".join(words).upper(), 4: "/".join(words), 5: "".join(words)}[style]
        out.append((name + (str(rng.randint(0, 2030)) if k % 4 == 0 else ""), 0))
    return out


def codes(token: str) -> list[int]:
    return [CLASSES.index(c) for c in token]


@lru_cache(maxsize=4)
def ratios(n: int = 4000, seed: int = 7, smoothing: float = 0.5) -> dict[str, float]:
    """log P(b|a, random) - log P(b|a, ordinary) of every character pair; a first character follows ''."""
    totals = [[[smoothing] * SIZE for _ in range(SIZE)] for _ in range(2)]
    for token, label in labelled_samples(n, seed):
        before = SIZE - 1
        for c in codes(token):
            totals[label][before][c] += 1
            before = c
    table = {}
    for a in range(SIZE):
        sums = [sum(totals[k][a][: SIZE - 1]) for k in (0, 1)]
        for b in range(SIZE - 1):
            table[(CLASSES[a] if a < SIZE - 1 else "") + CLASSES[b]] = math.log(totals[1][a][b] / sums[1]) - math.log(totals[0][a][b] / sums[0])
    return table


def ratio(token: str) -> float:
    """Mean log-likelihood ratio a character: positive where random is likelier."""
    table = ratios()
    return (table[token[0]] + sum(table[token[i : i + 2]] for i in range(len(token) - 1))) / len(token)


@lru_cache(maxsize=1)
def threshold(false_positive_rate: float = 0.001) -> float:
    """The ratio that so small a share of the ordinary samples of another seed exceeds."""
    scores = sorted(ratio(t) for t, label in labelled_samples(2000, 11) if not label)
    return max(0.0, scores[min(len(scores) - 1, int(len(scores) * (1 - false_positive_rate)))])


def is_random(token: str) -> bool:
    """Above the threshold. Runs without a letter and lower-case words without a digit are never secrets: a random key is one with a chance below 1e-4."""
    keyed = any(c.isupper() for c in token) or (any(c.isdigit() for c in token) and any(c.isalpha() for c in token))
    return keyed and ratio(token) > threshold()


KEYWORDS = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the fixed patterns, in code points, in order."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def markov_spans(text: str) -> list[tuple[int, int, int]]:
    return [(m.start(), 3, m.end()) for m in TOKEN.finditer(text) if is_random(m[0])]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_text(text: str | None) -> tuple[int, int, int, str, str]:
    """n_assign, n_access, n_hex, base_sha256, spans of one text."""
    base = base_spans(text := text or "")
    counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
    return (*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(sorted(base + markov_spans(text))))


def secret_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    A null or empty text has no spans (base_sha256 is then that of an empty string). Each row is scanned by
    itself: repeated rows give repeated results, other columns are not read, an empty table gives no rows.
    """
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*(scan_text(t) for t in batch.column(1).to_pylist()), strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types[1:], strict=True))], names)

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(text: str, mark: str = "[REDACTED]") -> str:
    """The text with every span, base or added, replaced."""
    out, at = [], 0
    for start, _, end in sorted(base_spans(text) + markov_spans(text)):
        if end > at:
            out += [text[at:start], mark] if start >= at else []
            at = end
    return "".join(out) + text[at:]

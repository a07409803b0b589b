"""Secret scans: plain patterns, and character Markov models of random strings and of ordinary identifiers.

Patterns give the base spans. The models give more: the parts of a run of the scanned alphabet whose log-likelihood
ratio, random against ordinary, is high both for each character and in all. Both are first-order Markov chains over the alphabet,
counted over labelled samples from every document (values of base spans are random, other tokens are ordinary) and over
generated ones, so they know strings that the corpus lacks. Counts are summed by key before a few thousand sums go to the
driver.

Defined results: null and empty texts have no spans; offsets are code points, ends exclusive; spans stand by start, then
in the order of ``KINDS``; a model span never overlaps a base span; repeated rows give repeated results; an empty table
gives no rows; other columns are ignored. Whole texts are scanned, whatever their length.
"""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, map_lists

KINDS = ("assign", "access", "hex", "markov")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
# runs are taken whole, so a bound on the length in the pattern drops the same matches as one after it
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
SIZE = len(ALPHABET) + 1  # the last stands for both ends
CODE = np.full(128, SIZE - 1, np.int64)
CODE[[ord(x) for x in ALPHABET]] = np.arange(len(ALPHABET))
#: A model span has this log ratio in all and this much for each character, at least.
LEAST_RATIO, LEAST_EACH = 18.0, 0.4


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    low = text.lower()
    if any(x in low for x in NAMES):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _pairs(token: str) -> np.ndarray:
    """Codes of the token's transitions, both ends included."""
    codes = CODE[np.frombuffer(f" {token} ".encode("ascii"), np.uint8)]
    return codes[:-1] * SIZE + codes[1:]


def generated_samples(seed: int = 7, each: int = 400) -> dict[str, list[str]]:
    """Labelled strings that any corpus may lack: random ones over usual alphabets, and identifiers put together from words."""
    rnd = random.Random(seed)
    kinds = ("0123456789abcdef", ALPHABET[:62], ALPHABET[:62] + "+/", ALPHABET[:62] + "_-", ALPHABET[:26] + ALPHABET[52:62], ALPHABET[26:62])
    words = "get set user name file path data count index value list map query result table column row key hash node tree list state time date error config option handler request response server client session buffer stream input output parse format write read open close update delete create build test main init default global local static public private"
    words += " message channel worker queue thread process kernel device driver network socket packet header body field record schema cluster partition block chunk image pixel color shape vector matrix tensor layer weight gradient sample label batch epoch metric score report summary detail search filter sort merge split join group count total amount price product item article chapter page section title author publisher language country region street number phone email address logout admin guest profile picture video audio caption comment reply follow share contact privacy policy terms service support question answer weather season january monday morning"
    words = words.split()
    ordinary = []
    for _ in range(each * len(kinds)):
        some = [rnd.choice(words) for _ in range(rnd.randint(2, 5))]
        titled, number = "".join(w.title() for w in some), str(rnd.randint(0, 99))
        styles = ("_".join(some), titled, some[0] + titled, "/".join(some), "-".join(some), ".".join(some), f"{some[0]}.{titled}", f"{'/'.join(some)}.{rnd.choice(('html', 'json', 'py', 'txt'))}", "_".join(some).upper())
        ordinary.append(rnd.choice(styles) + (number if rnd.random() < 0.2 else ""))
    return {"random": ["".join(rnd.choice(k) for _ in range(rnd.randint(16, 64))) for k in kinds for _ in range(each)], "ordinary": ordinary}


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """The table of log ratios, SIZE by SIZE, from all documents' labelled tokens and the generated ones."""

    def make():
        def apply(keys, texts):
            counts = np.zeros((2, SIZE * SIZE), np.int64)
            for text in texts:
                spans, i = base_spans(text), 0
                chosen: list[list[str]] = [[], []]
                for a, b, _ in spans:
                    chosen[0] += TOKEN.findall(text, a, b)[-1:]
                for m in TOKEN.finditer(text):
                    while i < len(spans) and spans[i][1] <= m.start():
                        i += 1
                    if i == len(spans) or spans[i][0] >= m.end():
                        chosen[1].append(m[0])
                for k, tokens in enumerate(chosen):
                    if tokens:
                        counts[k] += np.bincount(_pairs("\n".join(tokens)), minlength=SIZE * SIZE)
            at = np.flatnonzero(counts.ravel())
            return [at.tolist(), counts.ravel()[at].tolist()]

        return apply

    rows = map_lists(id_and_text(docs, id_col, text_col), "at int, n long", make).groupBy("at").agg(F.sum("n").alias("n")).collect()  # at most 2 * SIZE ** 2
    counts = np.zeros(2 * SIZE * SIZE)
    counts[[r["at"] for r in rows]] = [r["n"] for r in rows]
    counts = counts.reshape(2, SIZE, SIZE)
    for k, tokens in enumerate(generated_samples().values()):
        made = np.bincount(_pairs("\n".join(tokens)), minlength=SIZE * SIZE).reshape(SIZE, SIZE)
        # the generated strings weigh as much as the corpus's of their class, however many those are
        counts[k] += made * max(1.0, counts[k].sum() / made.sum())
    smooth = counts + 0.5
    logs = np.log(smooth / smooth.sum(2, keepdims=True))
    return logs[0] - logs[1]


def _best_parts(gains: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint parts of a row of numbers that reach ``LEAST_RATIO``: the largest sum, then the largest to its left and right."""
    out, todo = [], [(0, len(gains))]
    while todo:
        lo, hi = todo.pop()
        sums = np.concatenate([[0.0], np.cumsum(gains[lo:hi])])
        rise = sums - np.minimum.accumulate(sums)
        b = int(np.argmax(rise))
        if rise[b] < LEAST_RATIO:
            continue
        a = int(np.argmin(sums[: b + 1]))
        out.append((lo + a, lo + b))
        todo += [(lo, lo + a), (lo + b, hi)]
    return sorted(out)


def model_spans(text: str, ratios: np.ndarray, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """In each run of the alphabet, the parts whose ratios add up; no part holds a base span or a piece of one.

    A part takes in the letters and digits that adjoin it, so that no end of a key is left over.
    """
    runs = [m.span() for m in TOKEN.finditer(text)]
    if not runs:
        return []
    line = "\n".join([text[a:b] for a, b in runs])
    each = ratios[_pairs(line)]  # of the step into each character, and out of the last; a line end stands for both ends
    starts = np.cumsum([0, *(b - a + 1 for a, b in runs[:-1])])
    good = np.add.reduceat(np.maximum(each, 0), starts)
    found, i = [], 0
    for k in np.flatnonzero(good >= LEAST_RATIO).tolist():
        a, b = runs[k]
        steps = each[starts[k] : starts[k] + b - a + 1].copy()
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        barred = np.zeros(b - a, bool)
        for lo, hi, _ in taken[i:]:
            if lo >= b:
                break
            barred[max(0, lo - a) : max(0, hi - a)] = True
        steps[:-1][barred] = steps[1:][barred] = -1e9
        last = 0
        for x, y in _best_parts(steps):
            if steps[x:y].sum() < LEAST_EACH * (y - x):
                continue
            lo, hi = max(last, x - 1, 0), min(y, b - a)
            while lo > last and not barred[lo - 1] and text[a + lo - 1].isalnum():
                lo -= 1
            while hi < b - a and not barred[hi] and text[a + hi].isalnum():
                hi += 1
            if hi > lo:
                found.append((a + lo, a + hi, "markov"))
                last = hi
    return found


def _spans(texts: list[str], ratios: np.ndarray) -> list[tuple[list, list]]:
    """Per text its base spans and all its spans."""
    out = []
    for text in texts:
        base = base_spans(text)
        out.append((base, sorted([*base, *model_spans(text, ratios, base)], key=lambda s: (s[0], KINDS.index(s[2])))))
    return out


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans): arrays of (start, stop, kind)."""
    ratios = train(docs, id_col=id_col, text_col=text_col).ravel()

    def make():
        def apply(keys, texts):
            as_rows = lambda spans: [{"start": a, "stop": b, "kind": k} for a, b, k in spans]
            found = _spans(texts, ratios)
            return [keys, [as_rows(b) for b, _ in found], [as_rows(s) for _, s in found]]

        return apply

    span = "array<struct<start:long,stop:long,kind:string>>"
    return map_lists(id_and_text(docs, id_col, text_col), f"doc_id long, base {span}, spans {span}", make)


def span_digests(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans and all spans as a string."""
    said = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(k) for k in KINDS[:3]), F.sha2(said("base"), 256).alias("base_sha256"), said("spans").alias("spans"))


def redacted(docs: DataFrame, *, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span, merged where spans overlap, replaced by ``mark``; null text stays null, all else stays."""
    ratios = train(docs, id_col=docs.columns[0], text_col=text_col).ravel() if docs.columns else None
    names = docs.columns
    schema = docs.schema

    def make():
        def apply(*columns):
            texts = columns[names.index(text_col)]
            clean = []
            for text, (_, spans) in zip(texts, _spans([t or "" for t in texts], ratios), strict=True):
                parts, at = [], 0
                for a, b, _ in spans:
                    if b > at:
                        parts += [text[at : max(a, at)], mark if a >= at else ""]
                        at = b
                clean.append("".join(parts) + text[at:] if spans else text)
            return [clean if n == text_col else c for n, c in zip(names, columns, strict=True)]

        return apply

    return map_lists(docs, schema, make, text=names.index(text_col))

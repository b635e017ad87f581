"""Secret scans: fixed patterns, and two character Markov models compared by log-likelihood ratio.

The fixed patterns give the base spans (assign, access, hex). Beyond them, every run of token characters of MIN_RUN or more
is scored under a second-order Markov model of random strings and one of ordinary identifiers, both trained from labelled
samples; a run whose log-likelihood ratio reaches THRESHOLD in all and PER_CHAR on average is a span of kind markov.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog.llm.common import bounded_batches, edit_batches

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
DIGIT = re.compile("[0-9]")
MIN_RUN, THRESHOLD, PER_CHAR, NO_DIGIT = 16, 14.0, 0.6, 4.0
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
# Ordinary words that the labelled identifiers are made of.
WORDS = """access account action active address after agent alpha answer application archive array article attribute
author average balance batch before begin between binary board branch bridge bucket buffer build button cache calendar
camera cancel capacity category center channel chapter character check child circle class clean client clock cluster code
collection column command comment common company compare complete component computer condition config connection contact
container content context control copy corner count country course create current customer daily data database date
default delete delta department description design detail device dictionary different direct directory discount display
distance document domain double download driver dynamic edge editor element email empty enable encode engine entry
environment error event example execute export express extend external factory family feature field figure file filter
final first folder follow format forward frame function future gateway general global graph group handler header health
height hidden history house image import index info initial input inside install instance integer interface internal
invoice item iterator journal keyboard label language large last layer layout length level library license limit line
list local location logger login machine manager mapping market master maximum measure media member memory menu merge
message method metric middle minimum mobile model module monitor month mouse multiple name native network node normal
note notification number object offset online open operation option order origin output owner package page panel
parameter parent parser partition path pattern payment people percent period permission person phone picture pipeline
place plan player point policy position power preview price primary print priority private process product profile
program project property provider public purchase quality quantity query question queue random range rate reader record
reference region register release remote remove render repeat report request reserve reset resource response result
return review right role root route rule sample schedule schema screen script search section security segment select
sensor sequence serial server service session setting shadow shape share shipping simple single size source space
special stage standard start state static station status step storage store stream street string structure student style
subject submit summary support switch symbol system table target task team template terminal test text theme thread
ticket time title token total trace track traffic transaction transfer transform tree trigger type unit update upload
user utility valid value variable vector vendor version vertical video view virtual visible volume warehouse weather
website weight widget width window worker workflow world writer year zone und der die das nicht schaft heit keit ung lich
verbindung gesellschaft entwicklung wissenschaft que les une dans pour avec ement tion aux eau eur mente ando ción para
como desde los las del ado idad ing able ness ment er re th an in on at en nd ti es or te of ed is it al ar st to nt ng
se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur""".split()


def labelled_samples(seed: int = 17, n: int = 6000) -> list[tuple[str, int]]:
    """(string, 1 if random else 0), made by rule: draws from usual secret alphabets, and identifiers joined from WORDS."""
    rng = random.Random(seed)
    words = [w for w in WORDS if w.isascii()]
    upper, lower, digits = ALPHABET[26:52], ALPHABET[:26], ALPHABET[52:62]
    out = []
    for k in range(n):
        symbols = (upper + lower + digits, upper + lower + digits + "+/", upper + lower + digits + "_-", upper + digits, lower + digits, digits[:10] + "abcdef")[k % 6]
        out.append(("".join(rng.choice(symbols) for _ in range(rng.randint(16, 64))), 1))
        parts = [rng.choice(words) for _ in range(rng.randint(1, 7))]
        style = k % 8
        if style == 0:
            s = "_".join(parts)
        elif style == 1:
            s = "-".join(parts)
        elif style == 2:
            s = "".join(p.capitalize() for p in parts)
        elif style == 3:
            s = "_".join(parts).upper()
        elif style == 4:
            s = "/".join(parts)
        elif style == 5:
            s = "".join(parts).upper()
        elif style == 6:
            s = "-".join(parts) + rng.choice(["", "-" + str(rng.randint(1, 2030)), "_v" + str(rng.randint(1, 9)), "=" + str(rng.randint(0, 99))])
        else:
            s = "".join(parts)
        out.append((s, 0))
    for run in ("=" * 40, "-" * 40, "_" * 40, "/" * 20, "0" * 30, "1234567890" * 2, "2024-01-31", "a" * 30, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"):
        out += [(run, 0)] * 40
    for _ in range(n // 6):
        out.append((f"{rng.randint(1990, 2035)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", 0))
        out.append((str(rng.randint(0, 10 ** rng.randint(1, 20))), 0))
    return out


class Markov:
    """Second-order character model over ALPHABET, each symbol's odds interpolated with lower orders."""

    def __init__(self, strings: Iterable[str]) -> None:
        n = len(ALPHABET)
        index = {c: i for i, c in enumerate(ALPHABET)}
        counts = np.zeros((n + 1, n + 1, n))
        for s in strings:
            a = b = n  # before the first symbol
            for c in s:
                i = index.get(c)
                if i is None:
                    a = b = n
                    continue
                counts[a, b, i] += 1
                a, b = b, i
        one = counts.sum((0, 1)) + 0.5
        one /= one.sum()
        two = counts.sum(0) + 4 * one
        two /= two.sum(1, keepdims=True)
        three = counts + 4 * two[None]
        self.log = np.log(three / three.sum(2, keepdims=True))


class Ratio:
    """Log-likelihood ratio of random against ordinary."""

    def __init__(self, samples: Iterable[tuple[str, int]]) -> None:
        samples = list(samples)
        d = Markov(s for s, y in samples if y == 1).log - Markov(s for s, y in samples if y == 0).log
        n = len(ALPHABET)
        at = {i: c for i, c in enumerate(ALPHABET)} | {n: ""}
        self.pieces = {at[a] + at[b] + at[c]: float(d[a, b, c]) for a in range(n + 1) for b in range(n + 1) for c in range(n) if not (b == n and a != n)}

    def of(self, s: str) -> float:
        get = self.pieces
        return sum(get[s[max(0, i - 2) : i + 1]] for i in range(len(s)))


def scan(text: str, ratio: Ratio, threshold: float = THRESHOLD, per_char: float = PER_CHAR) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed; code points, end exclusive. Base spans always stay."""
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    base = sorted(out)
    k, reach = 0, -1
    for m in RUN.finditer(text):
        a, b = m.span()
        while k < len(base) and base[k][0] < b:
            reach = max(reach, base[k][1])
            k += 1
        if reach > a:
            continue  # it touches a base span
        sure = 1 if DIGIT.search(m.group()) else NO_DIGIT  # words of some languages run long: letters alone need more evidence
        if (x := ratio.of(m.group())) >= sure * threshold and x >= sure * per_char * (b - a):
            out.append((a, b, 3))
    return [(a, b, KINDS[k]) for a, k, b in sorted((a, k, b) for a, b, k in out)]


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())]))


def find_secrets(docs: DataFrame, samples: Iterable[tuple[str, int]] | None = None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, per_char: float = PER_CHAR, redacted: bool = True) -> DataFrame:
    """One row per input row: the id, secrets (array of start, end, kind) and, unless redacted is false, the text redacted, each
    span as [SECRET].

    samples: labelled strings (string, 1 random or 0 ordinary) to train on; None takes labelled_samples().
    Null text counts as empty: no spans, redacted ''. A null id stays null; repeated rows give repeated rows; an empty table
    gives an empty result; other columns are neither read nor returned. Overlapping spans are redacted as one. Narrow.
    """
    samples = list(labelled_samples() if samples is None else samples)
    schema = T.StructType([docs.schema[id_col], T.StructField("secrets", SPANS), *([T.StructField("redacted", T.StringType())] if redacted else [])])

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = Ratio(samples)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        for batch in batches:
            spans, clean = [], []
            for x in batch.column(1):
                text = x.as_py() or ""
                found = scan(text, ratio, threshold, per_char)
                spans.append([{"start": a, "end": b, "kind": k} for a, b, k in found])
                if redacted:
                    clean.append(redact(text, found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind), *([pa.array(clean, pa.string())] if redacted else [])], names=schema.names)

    bounded_batches(docs.sparkSession)
    return docs.select(id_col, text_col).mapInArrow(f, schema)


def redacted(docs: DataFrame, samples: Iterable[tuple[str, int]] | None = None, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """docs with every span of their texts as [SECRET]; chars_col, if docs has it, follows the new length. A null text stays
    null, a text without secrets as it is; all rows and columns stay."""
    samples = list(labelled_samples() if samples is None else samples)
    at = docs.columns.index(text_col)
    n_at = docs.columns.index(chars_col) if chars_col in docs.columns else None

    def make():
        ratio = Ratio(samples)

        def edit(batch: pa.RecordBatch) -> pa.RecordBatch:
            old = batch.column(at).to_pylist()
            new = [x if x is None else redact(x, scan(x, ratio)) for x in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if n_at is not None:
                counts = batch.column(n_at).to_pylist()
                columns[n_at] = pa.array([c if x is y or x == y else len(y) for c, x, y in zip(counts, old, new, strict=True)], batch.schema.field(n_at).type)
            return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

        return edit

    return edit_batches(docs, make)


def redact(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    pieces, at = [], 0
    merged: list[list[int]] = []
    for a, b, _ in spans:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in merged:
        pieces += [text[at:a], mark]
        at = b
    return "".join(pieces) + text[at:] if merged else text


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The query's columns: counts of the base kinds, their digest, and all spans as text."""
    said = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")
    base = F.filter("secrets", lambda x: x.kind != "markov")
    count = lambda k: F.size(F.filter("secrets", lambda x: x.kind == k)).cast("long").alias(f"n_{k}")
    return found.select(id_col, count("assign"), count("access"), count("hex"), F.sha2(said(base).cast("binary"), 256).alias("base_sha256"), said(F.col("secrets")).alias("spans"), count("markov"))


def base_digest(text: str | None) -> str:
    """base_sha256 by a plain reading of the patterns, for tests."""
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(out)).encode()).hexdigest()

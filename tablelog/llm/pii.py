"""Personal data: fixed patterns, and a semi-Markov conditional random field for the forms that they miss.

The fixed patterns give the base spans. Text around digits or addresses that no base span covers goes through a semi-Markov
CRF: it scores whole candidate segments (shape, digit counts, checksums, words before) under each type, and a dynamic
program over segments of at most MAX_TOKENS tokens picks the best boundaries and types together. The weights are trained here,
by gradient on the exact conditional likelihood, from labelled sentences made by rule.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog.llm.common import bounded_batches

KINDS = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
LOCAL_RUN = re.compile(r"[A-Za-z0-9._%+-]+$")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
#: Most tokens of an entity, characters of a stretch decoded at once, and most characters of a token in an entity.
MAX_TOKENS, STRETCH, MAX_CHARS = 14, 4000, 64
#: Characters of the longest entity: where a line is too long for one stretch, both sides see this much beyond the border.
LONGEST = MAX_TOKENS * (MAX_CHARS + 2)
TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
#: A stretch worth decoding: a run of seven or more digits with separators, or an address written around a word.
CUE = re.compile(r"[(]?[0-9](?:[ ().\-]{0,2}[0-9]){6,}|(?:@|[\[(] ?at ?[\])]| at (?=[A-Za-z0-9-]+ (?:dot|\[dot|\(dot)))", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of local@domain, found from each @ so that long runs cost no more than one look."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        a = at
        while a > end and LOCAL.match(text[a - 1]):
            a -= 1
        if a < at and (m := DOMAIN.match(text, at + 1)):
            out.append((a, m.end()))
            end = m.end()
        else:
            end = max(end, at + 1)  # a local part can't reach back over an @
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, in order."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if DIGITS.search(text) is None:
        return out
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            d = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(d) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


class Field:
    """Semi-Markov CRF: labels 0 (other, one token) and 1 to 4 (KINDS, up to MAX_TOKENS tokens)."""

    def __init__(self) -> None:
        self.w: dict[tuple[str, int], float] = defaultdict(float)

    @staticmethod
    def segments(text: str, tokens: list[tuple[int, int]]) -> dict[int, list[tuple[int, list[str]]]]:
        """end -> (start, features) of candidate entities; tokens are numbered, end exclusive."""
        out: dict[int, list[tuple[int, list[str]]]] = defaultdict(list)
        for i, (a, _) in enumerate(tokens):
            if not (text[a].isalnum() or text[a] in "(+["):
                continue
            digits = marks = 0
            for j in range(i, min(len(tokens), i + MAX_TOKENS)):
                c, d = tokens[j]
                if d - c > MAX_CHARS or j > i and text[tokens[j - 1][1] : c].strip(" ") or c - tokens[j - 1][1] > 2 and j > i or text[c : c + 1] in ",;!?|":
                    break
                w = text[c:d]
                if w[0].isdigit():
                    digits += d - c
                elif w == "@" or w.lower() == "at":
                    marks += 1
                if (digits >= 7 or marks) and j > i - 1 and text[d - 1].isalnum():
                    out[j + 1].append((i, Field.features(text, tokens, i, j + 1, digits)))
        return out

    @staticmethod
    def features(text: str, tokens: list[tuple[int, int]], i: int, j: int, n_digits: int) -> list[str]:
        s = text[tokens[i][0] : tokens[j - 1][1]]
        low = s.lower()
        shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", lambda m: "9" * min(len(m.group()), 5), low))
        before = text[tokens[i - 1][0] : tokens[i - 1][1]].lower() if i else "^"
        before2 = text[tokens[i - 2][0] : tokens[i - 2][1]].lower() if i > 1 else "^"
        after = text[tokens[j][0] : tokens[j][0] + 1] if j < len(tokens) else "$"
        d = re.sub(r"\D", "", s)
        at = re.search(r"@|[\[(] ?at ?[\])]| at ", low)
        dot = re.search(r"\.|[\[(] ?dot ?[\])]| dot ", low)
        out = ["bias", f"n={min(n_digits, 20)}", f"len={min(j - i, 15)}", f"before={before}", f"before2={before2}", f"after={'9' if after.isdigit() else 'a' if after.isalpha() else after}", f"glued={i > 0 and tokens[i - 1][1] == tokens[i][0]},{j < len(tokens) and tokens[j][0] == tokens[j - 1][1] and after not in '.,;:!?)'}"]
        if not at:
            out += [f"shape={shape[:30]}", f"letters={bool(re.search('[a-z]', low))}", f"open={s[0]}"]
            if 13 <= len(d) <= 19:
                out.append(f"luhn={luhn(d)},{len(d)}")
        else:
            ends = re.search(r"(?:\.|dot[\])]? ?) ?([a-z]{2,6})$", low)
            out += [f"at={at.group().strip(' ')}", f"dot={bool(dot)}", f"ends={bool(ends)}", f"begins={at.start() > 0}", f"words={min(len(re.findall(r'[a-z0-9]+', low)), 8)}", f"blanks={min(low.count(' '), 5)}"]
        return out

    def score(self, features: list[str], y: int) -> float:
        w = self.w
        return sum(w.get((f, y), 0.0) for f in features)

    def decode(self, text: str, tokens: list[tuple[int, int]], taken: Sequence[tuple[int, int]] = ()) -> list[tuple[int, int, int]]:
        """(kind, start, end) of the best segmentation whose entities touch none of taken."""
        n = len(tokens)
        segments = self.segments(text, tokens)
        if taken:
            ends, starts, held = [b for _, b in tokens], [a for a, _ in tokens], [0] * (n + 1)
            for x, y in taken:
                for t in range(bisect_right(ends, x), bisect_left(starts, y)):
                    held[t + 1] = 1
            held = list(accumulate(held))
            segments = {j: [(i, f) for i, f in xs if held[i] == held[j]] for j, xs in segments.items()}
        if not segments:
            return []
        best: list[list[float]] = [[0.0] + [-math.inf] * 4]
        back: list[list[tuple[int, int] | None]] = [[None] * 5]
        step = [[self.w.get((f"from={x}", y), 0.0) for y in range(5)] for x in range(5)]
        for j in range(1, n + 1):
            row, via = [-math.inf] * 5, [None] * 5
            x = max(range(5), key=lambda x: best[j - 1][x] + step[x][0])
            row[0], via[0] = best[j - 1][x] + step[x][0], (j - 1, x)
            for i, features in segments.get(j, ()):
                for y in range(1, 5):
                    s = self.score(features, y)
                    for x in range(5):
                        if (v := best[i][x] + step[x][y] + s) > row[y]:
                            row[y], via[y] = v, (i, x)
            best.append(row)
            back.append(via)
        out, j, y = [], n, max(range(5), key=lambda y: best[n][y])
        while j:
            i, x = back[j][y]
            if y:
                out.append((y - 1, tokens[i][0], tokens[j - 1][1]))
            j, y = i, x
        return out[::-1]

    def gradient(self, text: str, tokens: list[tuple[int, int]], gold: set[tuple[int, int, int]]) -> dict[tuple[str, int], float]:
        """Observed minus expected features; gold: (i, j, label) of the entities, in token numbers."""
        n, segments = len(tokens), self.segments(text, tokens)
        step = [[self.w.get((f"from={x}", y), 0.0) for y in range(5)] for x in range(5)]
        arcs: list[list[tuple[int, int, list[str], float]]] = [[] for _ in range(n + 1)]
        for j in range(1, n + 1):
            arcs[j].append((j - 1, 0, [], 0.0))
            for i, f in segments.get(j, ()):
                arcs[j] += [(i, y, f, self.score(f, y)) for y in range(1, 5)]
        plus = lambda xs: (m + math.log(sum(math.exp(x - m) for x in xs))) if (m := max(xs)) > -math.inf else -math.inf
        ahead = [[0.0] + [-math.inf] * 4] + [[-math.inf] * 5 for _ in range(n)]
        for j in range(1, n + 1):
            got: list[list[float]] = [[] for _ in range(5)]
            for i, y, _, s in arcs[j]:
                got[y] += [ahead[i][x] + step[x][y] + s for x in range(5) if ahead[i][x] > -math.inf]
            ahead[j] = [plus(g) if g else -math.inf for g in got]
        behind = [[-math.inf] * 5 for _ in range(n)] + [[0.0] * 5]
        into: list[list[list[float]]] = [[[] for _ in range(5)] for _ in range(n + 1)]
        for j in range(n, 0, -1):
            if j < n:
                behind[j] = [plus(g) if g else -math.inf for g in into[j]]
            for i, y, _, s in arcs[j]:
                if behind[j][y] > -math.inf:
                    for x in range(5):
                        into[i][x].append(step[x][y] + s + behind[j][y])
        z = plus(ahead[n])
        g: dict[tuple[str, int], float] = defaultdict(float)
        for j in range(1, n + 1):
            for i, y, f, s in arcs[j]:
                for x in range(5):
                    if ahead[i][x] > -math.inf and (p := math.exp(ahead[i][x] + step[x][y] + s + behind[j][y] - z)) > 1e-6:
                        g[f"from={x}", y] -= p
                        for k in f:
                            g[k, y] -= p
        known = {(i, j): f for j, xs in segments.items() for i, f in xs}
        at, x = 0, 0
        ends = {i: (j, y) for i, j, y in gold}
        while at < n:
            j, y = ends.get(at, (at + 1, 0))
            if y and (at, j) not in known:
                j, y = at + 1, 0
            g[f"from={x}", y] += 1
            for k in known[at, j] if y else ():
                g[k, y] += 1
            at, x = j, y
        return g

    def train(self, sentences: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = 4, rate: float = 0.3, seed: int = 3) -> Field:
        squares: dict[tuple[str, int], float] = defaultdict(float)
        rng = random.Random(seed)
        sentences = list(sentences)
        for _ in range(epochs):
            rng.shuffle(sentences)
            for text, spans in sentences:
                tokens = [m.span() for m in TOKEN.finditer(text)]
                first, last = {a: i for i, (a, _) in enumerate(tokens)}, {b: i + 1 for i, (_, b) in enumerate(tokens)}
                gold = {(first[a], last[b], k + 1) for k, a, b in spans if a in first and b in last}
                for k, d in self.gradient(text, tokens, gold).items():
                    squares[k] += d * d
                    self.w[k] += rate * (d - 1e-3 * self.w.get(k, 0.0)) / (math.sqrt(squares[k]) + 1e-2)
        return self


def labelled_sentences(seed: int = 23, n: int = 500) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """(text, (kind, start, end) spans), made by rule: personal data in many spellings among numbers that are none."""
    rng = random.Random(seed)
    d = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    words = "the of and to in is on that with for from was are at by an order see page in about call version code year item lot total und der les que con".split()
    names = "anna john maria li omar kate support info sales paul nina x.y jo_b contact".split()
    hosts = "example mail company test web post school shop".split()
    tlds = "com org net edu de fr io co".split()

    def card() -> str:
        body = rng.choice("3456") + d(14)
        return next(body + str(c) for c in range(10) if luhn(body + str(c)))

    def personal() -> tuple[int, str, str]:
        kind = rng.choice((0, 0, 1, 2, 2, 3, 3, 3))
        if kind == 0:
            at, dot = rng.choice([("@", "."), (" [at] ", " [dot] "), (" (at) ", " (dot) "), (" at ", " dot "), ("[at]", "."), ("(at)", "."), (" @ ", "."), (" [at] ", ".")])
            return 0, rng.choice(names) + rng.choice(["", d(2)]) + at + rng.choice(hosts) + dot + rng.choice(tlds), rng.choice(["mail", "email:", "write to", "contact", "at", ""])
        if kind == 1:
            return 1, ".".join(str(rng.randint(0, 255)) for _ in range(4)), rng.choice(["ip", "host", "address", "from", ""])
        if kind == 2:
            c = card()
            sep = rng.choice([".", " - ", "  ", " ", "-", ""])
            return 2, sep.join(c[i : i + 4] for i in range(0, 16, 4)), rng.choice(["card", "visa", "card number", "cc:", "pay with", ""])
        a, b, c = rng.choice("23456789") + d(2), d(3), d(4)
        return 3, rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+1 {a} {b} {c}", f"1-{a}-{b}-{c}", f"00{rng.randint(30, 49)} {a} {b}{c}", f"0{a} {b} {c}"]), rng.choice(["call", "phone", "tel", "tel.", "fax:", "mobile", "reach me at", ""])

    def other() -> str:
        return rng.choice([
            f"{rng.randint(1, 9)}.{rng.randint(0, 9)}", f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1990, 2030)}",
            f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d} {rng.randint(0, 23):02d}:{d(2)}:{d(2)}", d(rng.randint(7, 20)), f"{d(3)},{d(3)},{d(3)}", f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}", f"id {d(10)}", f"order {d(8)}",
            f"{d(4)} {d(4)} {d(4)} {d(4)} {d(4)} {d(4)}", f"{d(1)}.{d(7)}", f"{d(2)} {d(2)} {d(2)} {d(2)}", f"{rng.choice(names)} at {rng.choice(hosts)}", f"at {rng.choice(words)}", f"@{rng.choice(names)}", f"{d(2)} @ {d(2)}", f"{d(8)}-{d(4)}", f"{rng.randint(1900, 1990)}-{rng.randint(1991, 2030)}",
        ])

    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.randint(1, 3)):
            text += " ".join(rng.choice(words) for _ in range(rng.randint(0, 4))) + " "
            if rng.random() < 0.5:
                kind, s, lead = personal()
                text += lead + " " if lead else ""
                spans.append((kind, len(text), len(text) + len(s)))
                text += s
            else:
                text += other()
            text += rng.choice([" ", ", ", ". ", "; "])
        out.append((text, spans))
    return out


@lru_cache(maxsize=1)
def trained() -> dict[tuple[str, int], float]:
    """The weights learned from labelled_sentences()."""
    return {k: v for k, v in Field().train(labelled_sentences()).w.items() if abs(v) > 1e-3}


def stretches(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, first, last): parts of text around cues that don't lie inside base spans, each within a line.

    A stretch answers for the entities that start from first up to last. Beyond STRETCH characters another one begins; both
    reach LONGEST characters over the border between them, so an entity there lies whole in the one that answers for it.
    """
    out: list[list[int]] = []
    covered = sorted((a, b) for _, a, b in base)
    k = 0
    for m in CUE.finditer(text):
        while k < len(covered) and covered[k][1] <= m.start():
            k += 1
        at = m.start()
        for n in range(k, len(covered)):
            c, d = covered[n]
            if c >= m.end() or any(x.isalnum() or x == "@" for x in text[at:c]):
                break
            at = max(at, d)
        if not any(x.isalnum() or x == "@" for x in text[at : m.end()]):
            continue
        a, b = max(0, m.start() - 80), min(len(text), m.end() + 80)
        a, b = max(a, text.rfind("\n", a, m.start()) + 1), b if (e := text.find("\n", m.end(), b)) < 0 else e
        if out and a <= out[-1][1] and b - out[-1][0] <= STRETCH:
            out[-1][1] = max(b, out[-1][1])
        elif out and a <= out[-1][1]:
            c, d = max(0, m.start() - LONGEST), min(len(text), m.start() + LONGEST)
            out[-1][1] = max(out[-1][1], d if (e := text.find("\n", m.start(), d)) < 0 else e)
            out.append([max(c, text.rfind("\n", c, m.start()) + 1), b, m.start()])
        else:
            out.append([a, b, a])
    lasts = [*(x[2] for x in out), len(text)][1:]
    return [(a, b, first, last) for (a, b, first), last in zip(out, lasts, strict=True) if a < b]


def scan(text: str, field: Field) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, is_base) by kind, then start. Base spans always stay; added ones touch no base span."""
    base = base_spans(text)
    out = [(k, a, b, True) for k, a, b in base]
    taken = sorted((a, b) for _, a, b in base)
    over, reach = 0, list(accumulate((b for _, b in taken), max))
    for a, b, first, last in stretches(text, base):
        piece = text[a:b]
        near = [(x - a, y - a) for x, y in taken[bisect_right(reach, a) : bisect_left(taken, (b,))]]
        for kind, c, d in field.decode(piece, [m.span() for m in TOKEN.finditer(piece)], near):
            if first <= c + a < last and c + a >= over:
                over = d + a
                if all(d + a <= x or c + a >= y for x, y in taken):
                    out.append((kind, c + a, d + a, False))
    return sorted(out)


def find_pii(docs: DataFrame, weights: dict[tuple[str, int], float] | None = None, id_col: str = "doc_id", text_col: str = "text", redacted: bool = True) -> DataFrame:
    """One row per input row: the id, pii (array of start, end, kind, base) and, unless redacted is false, the text redacted, each
    span as [KIND].

    weights: of a trained Field; None trains on labelled_sentences(). Null text counts as empty: no spans, redacted ''.
    A null id stays null; repeated rows give repeated rows; an empty table gives an empty result; other columns are neither
    read nor returned. Overlapping base spans are all reported and redacted as one. Whole texts, one narrow pass.
    """
    weights = dict(trained() if weights is None else weights)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("base", pa.bool_())]))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("base", T.BooleanType())])
    schema = T.StructType([docs.schema[id_col], T.StructField("pii", T.ArrayType(span)), *([T.StructField("redacted", T.StringType())] if redacted else [])])

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field()
        field.w.update(weights)
        for batch in batches:
            spans, clean = [], []
            for x in batch.column(1):
                text = x.as_py() or ""
                found = scan(text, field)
                spans.append([{"start": a, "end": b, "kind": KINDS[k], "base": s} for k, a, b, s in found])
                if redacted:
                    clean.append(redact(text, found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind), *([pa.array(clean, pa.string())] if redacted else [])], names=schema.names)

    bounded_batches(docs.sparkSession)
    return docs.select(id_col, text_col).mapInArrow(f, schema)


def redact(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    if not spans:
        return text
    merged: list[list[int]] = []
    for k, a, b, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([k, a, b])
    pieces, at = [], 0
    for k, a, b in merged:
        pieces += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = b
    return "".join(pieces) + text[at:]


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The query's columns: counts of base spans by kind, their digest, and all spans as text."""
    said = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")
    base = F.filter("pii", lambda x: x.base)
    count = lambda k: F.size(F.filter("pii", lambda x: x.base & (x.kind == k))).cast("long").alias(f"n_{k}")
    return found.select(id_col, *map(count, KINDS), F.sha2(said(base).cast("binary"), 256).alias("base_sha256"), said(F.col("pii")).alias("spans"))

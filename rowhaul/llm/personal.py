"""Personal data by a semi-Markov conditional random field.

Base spans follow fixed patterns. Beyond them, stretches around digits and at
signs are cut into segments: each segment is one token of no interest or a whole
candidate entity, as long as its kind can be: an address of at most ``ADDRESS``
characters, spelled-out signs counted as one each, or a number of at most
``DIGITS`` digits, however they are grouped. Features see the candidate as a
whole (its shape, digits, checksum, groups, what stands beside it). Dynamic
programming over bounded segments finds the best boundaries and types together.

The weights are learned here, by gradient steps on the likelihood (forward and
backward sums over all segmentations), from a bounded sample: at most
``SAMPLE`` documents of at most ``LONGEST`` bytes, and of these the stretches of
at most ``STRETCH`` characters. They are drawn by a hash of the id: three of four
with base spans, the kinds in turn as far as each has any, and one for three of
these with digits or at signs but no base span. Spans are shown as they are, in other usual spellings
(national phone numbers, dotted cards, spelled-out at signs) and, as what to
leave alone, with something alike in their place (dates, amounts, failing
checksums). Base spans stay as they are; others may not overlap them.

Defined results: a null or empty text has no spans; texts are searched whole,
in time linear in their length; equal rows give equal results; input columns
named like a result column are replaced; an empty table gives an empty result,
and with nothing to learn from there are base spans only.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowhaul.llm.frames import map_batches

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 96
#: Most bytes of a document to learn from, and most characters of a stretch of it; what is searched has no such bounds.
LONGEST = 50_000
STRETCH = 600
#: Most characters of an email address and most digits of a card number.
ADDRESS = 254
DIGITS = 19
EPOCHS = 8

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]")
_SPELLED = re.compile(r"[\[(] ?(?:at|dot) ?[\])]")
_TRIGGER = re.compile(r"[0-9@]|[\[(] ?(?:at|dot) ?[\])]")
_NUMBER = re.compile(r"[+(]?[0-9][0-9 ().+/-]*[0-9]")
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+ ?(?:@|[\[(] ?at ?[\])]) ?[A-Za-z0-9-]+(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]+)+")
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_AT = re.compile(r"@|[\[(] ?at ?[\])]")
_DOT = re.compile(r" ?(?:\.|[\[(] ?dot ?[\])]) ?")
_WORD = re.compile(r"\S+")
_TOKEN = re.compile(r"[^\W_]+|[^\s]")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if k % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _emails(text: str):
    """As the pattern finds them: around each at sign, left to the first other character or the match before."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end(), "email"
            done = at = match.end()
        else:
            at += 1
            done = max(done, at)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and then by kind."""
    spans: list[Span] = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                spans.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _NO_DIGIT.sub("", m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    spans.append((m.start(), m.end(), "card"))
        for m in _PHONE.finditer(text):
            if 10 <= len(_NO_DIGIT.sub("", m.group())) <= 15:
                spans.append((m.start(), m.end(), "phone"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def regions(text: str, margin: int = 2) -> list[tuple[int, int]]:
    """Stretches of words around digits and at signs, each within one line."""
    if not _TRIGGER.search(text):
        return []
    out: list[tuple[int, int]] = []
    at = 0
    for line in text.split("\n"):
        if _TRIGGER.search(line):
            words = [m.span() for m in _WORD.finditer(line)]
            # a spelled-out sign may lie across three words
            signs = [m.span() for m in _SPELLED.finditer(line)]
            hot, k = [], 0
            for n, (a, b) in enumerate(words):
                while k < len(signs) and signs[k][1] <= a:
                    k += 1
                if (k < len(signs) and signs[k][0] < b) or _TRIGGER.search(line, a, b):
                    hot.append(n)
            first = last = None
            for k in hot:
                if first is None or k - margin > last + 1:
                    if first is not None:
                        out.append((at + words[first][0], at + words[last][1]))
                    first = max(0, k - margin)
                last = min(len(words) - 1, k + margin)
            if first is not None:
                out.append((at + words[first][0], at + words[last][1]))
        at += len(line) + 1
    return out


def _runs(part: str) -> str:
    """The shape of a segment: letters as a, digits as their number, other characters as they are."""
    return re.sub(r"[0-9]+", lambda m: str(min(9, len(m.group()))), re.sub(r"[^\W\d_]+", "a", part))


def features(kind: str, part: str, before: str, after: str) -> list[str]:
    """What is seen of a candidate: the whole of it, and its neighbours."""
    digits = _NO_DIGIT.sub("", part)
    n, letters = len(digits), any(c.isalpha() for c in part)
    out = [f"{kind}:bias", f"{kind}:letters={letters}", f"{kind}:digits={n if n < 20 else 20}"]
    if kind in ("card", "phone"):
        groups = [len(g) for g in re.findall(r"[0-9]+", part)]
        out += [f"{kind}:groups={len(groups) if len(groups) < 8 else 8}", f"{kind}:plus={part[0] == '+'}", f"{kind}:bracket={part[0] == '('}", f"{kind}:shape={_runs(part)[:20]}"]
        if kind == "card":
            out.append(f"card:luhn={14 <= n <= 19 and luhn(digits)}")
    elif kind == "ip":
        parts = part.split(".")
        out.append(f"ip:octets={len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts)}")
    else:
        signs = part.count("@") + len(re.findall(r"[\[(] ?at ?[\])]", part))
        dots = part.count(".") + len(re.findall(r"[\[(] ?dot ?[\])]", part))
        out += [f"email:signs={min(2, signs)}", f"email:dots={min(3, dots)}", f"email:words={min(6, len(part.split()))}"]
    out.append(f"{kind}:left={'edge' if not before else 'word' if before.isalnum() else 'space' if before.isspace() else before if before in '@.+-/(' else 'other'}")
    out.append(f"{kind}:right={'edge' if not after else 'word' if after.isalnum() else 'space' if after.isspace() else after if after in '@+-/)' else 'other'}")
    return out


def outside(token: str) -> list[str]:
    """What is seen of a token that belongs to no entity."""
    if token.isdigit():
        return ["out:digits", f"out:digits={min(20, len(token))}"]
    return [f"out:{token}" if token in "@+" else "out:word" if token.isalnum() else "out:sign"]


class Cover:
    """Spans by start, for lookups of those near a stretch."""

    def __init__(self, spans: list[Span]):
        self.spans = sorted(spans)
        self.starts = [s for s, _, _ in self.spans]
        self.ends = list(accumulate((e for _, e, _ in self.spans), max))

    def meets(self, start: int, end: int) -> bool:
        """Whether any span overlaps the stretch: of those that start before its end the furthest end lies behind its start."""
        k = bisect_left(self.starts, end)
        return k > 0 and self.ends[k - 1] > start

    def near(self, start: int, end: int) -> list[Span]:
        """The spans from the first to the last that overlap the stretch."""
        return self.spans[bisect_right(self.ends, start) : bisect_left(self.starts, end)]


class Lattice:
    """All segmentations of one region: the segments that end at each token."""

    def __init__(self, text: str, start: int, end: int, taken: list[Span]):
        self.tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, start, end)]
        cover = Cover(taken)
        busy = [cover.meets(a, b) for a, b in self.tokens]
        starts = self.numbers(text, busy)
        for i, j in self.addresses(text, start, busy):
            starts[j].append(i)
        self.ending: list[list[tuple[int, str | None, list[str]]]] = []
        for j, (a, b) in enumerate(self.tokens):
            own = [(j, None, outside(text[a:b]))]
            for i in sorted(starts[j], reverse=True):
                s = self.tokens[i][0]
                part = text[s:b]
                before, after = text[s - 1] if s else "", text[b] if b < len(text) else ""
                own += [(i, kind, features(kind, part, before, after)) for kind in self.possible(part)]
            self.ending.append(own)

    def numbers(self, text: str, busy: list[bool]) -> list[list[int]]:
        """For each token the tokens at which a number that ends with it may start."""
        # digits in a token, none for a sign between digits, beyond the most for anything else
        digits = [b - a if _NO_DIGIT.search(text, a, b) is None else 0 if text[a] in "().+/-" else DIGITS + 1 for a, b in self.tokens]
        apart = [bool(text[e:s].strip(" ")) for (_, e), (s, _) in zip(self.tokens, self.tokens[1:])]
        starts: list[list[int]] = [[] for _ in self.tokens]
        for j, own in enumerate(starts):
            if 0 < digits[j] <= DIGITS:
                total, i = 0, j
                while i >= 0 and not busy[i] and (total := total + digits[i]) <= DIGITS and (i == j or not apart[i]):
                    if digits[i] or (text[self.tokens[i][0]] in "+(" and digits[i + 1]):
                        own.append(i)
                    i -= 1
        return starts

    def addresses(self, text: str, start: int, busy: list[bool]):
        """(first, last) token of what may be an address, around each sign."""
        if not self.tokens:
            return
        begins, ends = [a for a, _ in self.tokens], [b for _, b in self.tokens]
        taken = [0, *accumulate(busy)]
        for sign in _AT.finditer(text, start, ends[-1]):
            left = sign.start() - (sign.start() > start and text[sign.start() - 1] == " ")
            low = left
            while low > start and left - low < ADDRESS and _LOCAL.match(text[low - 1]):
                low -= 1
            firsts = [i for i in range(bisect_left(begins, low), bisect_left(begins, left)) if text[begins[i]].isalnum() or text[begins[i]] == "+"]
            at = sign.end() + (text[sign.end() : sign.end() + 1] == " ")
            label, plain, dots = _LABEL.match(text, at, ends[-1]), 0, 0
            while firsts and label and plain < ADDRESS:
                if dots:
                    for j in range(bisect_right(ends, label.start()), bisect_right(ends, label.end())):
                        host = plain + ends[j] - label.start()
                        if host >= ADDRESS or taken[j + 1] > taken[firsts[-1]]:
                            break
                        if text[ends[j] - 1].isalnum():
                            yield from ((i, j) for i in firsts if left - begins[i] + 1 + host <= ADDRESS and taken[j + 1] == taken[i])
                plain += label.end() - label.start() + 1
                dot = _DOT.match(text, label.end(), ends[-1])
                label, dots = _LABEL.match(text, dot.end(), ends[-1]) if dot else None, 1

    def holds(self, spans: list[Span]) -> bool:
        """Whether each of the spans is a segment here."""
        own = {(self.tokens[i][0], self.tokens[j][1], kind) for j, ending in enumerate(self.ending) for i, kind, _ in ending if kind}
        return own.issuperset(spans)

    @staticmethod
    def possible(part: str) -> list[str]:
        digits = len(_NO_DIGIT.sub("", part))
        letters = any(c.isalpha() for c in part)
        out = []
        if letters and _ADDRESS.fullmatch(part):
            out.append("email")
        if _NUMBER.fullmatch(part):
            if part.count(".") == 3 and 4 <= digits <= 12:
                out.append("ip")
            if 12 <= digits <= 19:
                out.append("card")
            if 7 <= digits <= 15 and (part.count(".") != 3 or part[0] == "+"):
                out.append("phone")
        return out

    def best(self, weights: dict[str, float]) -> list[Span]:
        """The entities of the segmentation with the highest score."""
        score, back = [0.0], []
        for own in self.ending:
            top = max(((score[i] + sum(weights.get(f, 0.0) for f in fs), -k) for k, (i, _, fs) in enumerate(own)))
            score.append(top[0])
            back.append(own[-top[1]])
        out, j = [], len(self.ending)
        while j:
            i, kind, _ = back[j - 1]
            if kind:
                out.append((self.tokens[i][0], self.tokens[j - 1][1], kind))
            j = i
        return out[::-1]

    def gradient(self, weights: dict[str, float], gold: list[Span]) -> dict[str, float]:
        """Counted less expected features: the slope of the log likelihood of the right segmentation."""
        n = len(self.tokens)
        right = {(a, b, k) for a, b, k in gold}
        inside = [any(a <= s and e <= b for a, b, _ in gold) for s, e in self.tokens]
        edges = [(i, j, kind, fs, sum(weights.get(f, 0.0) for f in fs)) for j, own in enumerate(self.ending) for i, kind, fs in own]
        forward, backward = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
        forward[0] = backward[n] = 0.0
        add = lambda x, y: max(x, y) + math.log1p(math.exp(-abs(x - y))) if min(x, y) > -math.inf else max(x, y)
        for i, j, _, _, s in edges:
            forward[j + 1] = add(forward[j + 1], forward[i] + s)
        for i, j, _, _, s in reversed(edges):
            backward[i] = add(backward[i], backward[j + 1] + s)
        slope: dict[str, float] = {}
        for i, j, kind, fs, s in edges:
            real = (self.tokens[i][0], self.tokens[j][1], kind) in right if kind else not inside[j]
            change = real - math.exp(min(0.0, forward[i] + s + backward[j + 1] - forward[n]))
            for f in fs:
                slope[f] = slope.get(f, 0.0) + change
        return slope


def spellings(text: str, span: Span, rng: random.Random) -> tuple[str, Span] | None:
    """The same text with the entity written in another usual way."""
    a, b, kind = span
    part = text[a:b]
    if kind == "email":
        name, host = part.split("@", 1)
        at, dot = rng.choice([("[at]", "."), (" [at] ", " [dot] "), ("(at)", "."), (" (at) ", " (dot) ")])
        part = (name + at + host.replace(".", dot)).lstrip("._%+-")
    elif kind == "phone":
        digits = _NO_DIGIT.sub("", part)
        ten = digits[-10:]
        part = rng.choice([f"({ten[:3]}) {ten[3:6]}-{ten[6:]}", f"00{digits[:-10] or 1} {ten[:3]} {ten[3:6]} {ten[6:]}", f"{ten[:3]}-{ten[3:6]}-{ten[6:]}"])
    elif kind == "card":
        digits = _NO_DIGIT.sub("", part)
        part = ".".join(digits[i : i + 4] for i in range(0, len(digits), 4))
    else:
        return None
    return text[:a] + part + text[b:], (a, a + len(part), kind)


def broken(text: str, span: Span, rng: random.Random) -> str | None:
    """The same text with something like the entity in its place that is none."""
    a, b, kind = span
    part = text[a:b]
    if kind == "card":
        part = rng.choice([part[:-1] + str((int(part[-1]) + rng.randrange(1, 9)) % 10), _NO_DIGIT.sub("", part)[:-4]])
        part = "" if luhn(_NO_DIGIT.sub("", part)) else part
    elif kind == "ip":
        part = rng.choice([part.rsplit(".", 1)[0], f"{rng.randrange(256, 999)}." + part.split(".", 1)[1], part.rsplit(".", 1)[0] + f".{rng.randrange(256, 999)}"])
    elif kind == "phone":
        n = rng.randrange
        part = rng.choice([f"{n(1900, 2100)}-{n(1, 13):02}-{n(1, 29):02}", f"{n(1, 29):02}.{n(1, 13):02}.{n(1900, 2100)}", f"{n(1, 999)},{n(100, 999)},{n(100, 999)}", f"{n(10**6, 10**11)}", f"{n(1, 24)}:{n(10, 59)}:{n(10, 59)}", f"{n(1, 999)}-{n(1, 999)}", f"{n(100, 9999)} {n(100, 9999)} {n(10, 999)}", f"{n(1, 99)}.{n(10**6, 10**8)}"])
    else:
        part = rng.choice([part.split("@")[0], part.split("@")[1], "@" + part.split("@")[1].split(".")[0]])
    return text[:a] + part + text[b:] if part else None


def draw_sample(df: DataFrame, doc_id: str, text: str, sample: int) -> list[tuple[int, int]]:
    """The documents to learn from, as hashes of id and text, in the order of their draw."""
    t = F.col(text)
    likely = df.where((F.octet_length(t) <= LONGEST) & (t.contains("@") | t.rlike("[0-9](?:[ -]?[0-9]){6}|[0-9][.][0-9]|[+][0-9]")))
    hashed = likely.select(F.xxhash64(F.lit("personal"), F.col(doc_id)).alias("draw"), F.xxhash64(t).alias("tie"), t.alias("body"))

    def offer(batches):
        # each task offers its first rows of each kind, so only numbers move; the texts chosen follow
        best: list[list[tuple[int, int]]] = [[] for _ in range(len(KINDS) + 1)]
        for batch in batches:
            for draw, tie, body in zip(*(c.to_pylist() for c in batch.columns)):
                kinds = {KINDS.index(k) for _, _, k in base_spans(body)}
                for k in kinds or {len(KINDS)}:
                    best[k].append((draw, tie))
                    if len(best[k]) > 8 * sample:
                        best[k] = sorted(set(best[k]))[:sample]
        rows = [(k, *x) for k, own in enumerate(best) for x in sorted(set(own))[:sample]]
        columns = list(zip(*rows)) if rows else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.int32(), pa.int64(), pa.int64()))], names=["kind", "draw", "tie"])

    offers = hashed.mapInArrow(offer, "kind int, draw long, tie long").distinct()
    first = offers.withColumn("rank", F.row_number().over(Window.partitionBy("kind").orderBy("draw", "tie"))).where(F.col("rank") <= sample)
    ranked = sorted((r["rank"], r["kind"], (r["draw"], r["tie"])) for r in first.collect())
    # the kinds in turn; a document with spans of several kinds is one document
    real = list(dict.fromkeys(x for _, kind, x in ranked if kind < len(KINDS)))[: sample - sample // 4]
    plain = [x for _, kind, x in ranked if kind == len(KINDS)][: len(real) // 3]
    return sorted([*real, *plain])


def learn(df: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, epochs: int = EPOCHS) -> dict[str, float]:
    """Weights from a bounded sample of the texts with base spans, and of some that only look like it."""
    drawn = draw_sample(df, doc_id, text, sample)
    draw, tie = F.xxhash64(F.lit("personal"), F.col(doc_id)), F.xxhash64(F.col(text))
    chosen = df.where(draw.isin([d for d, _ in drawn]) & tie.isin([x for _, x in drawn])).select(draw.alias("draw"), tie.alias("tie"), F.col(text).alias("body"))
    bodies = {(r.draw, r.tie): r.body for r in chosen.dropDuplicates(["draw", "tie"]).collect()} if drawn else {}
    rng, examples = random.Random(2), []
    for body in (bodies[x] for x in drawn):
        spans = base_spans(body)
        for a, b in regions(body):
            part, own = body[a:b], [(s - a, e - a, k) for s, e, k in spans if a <= s and e <= b]
            own = [x for x in own if not any(y is not x and y[0] < x[1] and x[0] < y[1] for y in own)]
            if len(part) > STRETCH:
                continue
            examples.append((part, own))
            for span in own:
                if len(own) == 1 and (other := spellings(part, span, rng)):
                    examples.append((other[0], [other[1]]))
                if len(own) == 1:
                    examples += [(other, []) for _ in range(2) if (other := broken(part, span, rng)) and not base_spans(other)]
    rng.shuffle(examples)
    examples = examples[: 6 * sample]
    lattices = [(Lattice(part, 0, len(part), []), own) for part, own in examples]
    # a span that begins or ends within a token is no segment, so nothing can be learned from it
    lattices = [(lattice, own) for lattice, own in lattices if lattice.holds(own)]
    weights: dict[str, float] = {}
    squares: dict[str, float] = {}
    for _ in range(epochs):
        rng.shuffle(lattices)
        for lattice, own in lattices:
            for f, g in lattice.gradient(weights, own).items():
                if g:
                    squares[f] = squares.get(f, 1e-6) + g * g
                    weights[f] = weights.get(f, 0.0) * (1 - 1e-4) + 0.7 * g / math.sqrt(squares[f])
    return weights


def all_spans(text: str, weights: dict[str, float]) -> tuple[list[Span], list[Span]]:
    """(base spans, base and further spans)."""
    base = base_spans(text)
    more: list[Span] = []
    if weights:
        cover = Cover(base)
        for a, b in regions(text):
            more += [s for s in Lattice(text, a, b, cover.near(a, b)).best(weights) if not cover.meets(s[0], s[1])]
    return base, sorted([*base, *more], key=lambda s: (s[0], KINDS.index(s[2])))


def written_spans(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each stretch of spans replaced by the kind of its first."""
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


RESULT = [*(T.StructField(f"n_{k}", T.LongType()) for k in KINDS), T.StructField("base", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("masked", T.StringType())]


def find_personal(df: DataFrame, weights: dict[str, float], text: str = "text") -> DataFrame:
    """``df`` with counts of base spans, ``base`` and ``spans`` as kind:start:end, and ``masked``, the text without them (null stays null)."""

    def measure(column):
        rows = []
        for body in column.to_pylist():
            base, spans = all_spans(body, weights) if body else ([], [])
            counts = [sum(k == kind for _, _, k in base) for kind in KINDS]
            rows.append([*counts, written_spans(base), written_spans(spans), masked(body, spans) if spans else body])
        columns = list(zip(*rows)) if rows else [()] * len(RESULT)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i < len(KINDS) else pa.string()) for i, c in enumerate(columns)], names=[f.name for f in RESULT])

    return map_batches(df, text, RESULT, measure)

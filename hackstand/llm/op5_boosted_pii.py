"""Personal data by candidate gradient boosting.

Generators with high recall propose spans that may overlap: every plain or disguised address, every long run of digits and
its parts, every long run of mixed signs and every value named like a key or password. Base rules accept what they accept. The other candidates get a probability from boosted trees over features of
their format and context; a threshold per kind, calibrated for precision on held-out candidates, selects what is added.

The trees learn from the corpus itself: base matches of a bounded sample of documents are positives, as they stand and in
disguises that the base rules miss (``at``, ``dot``, no plus, other separators), always in their own context; candidates that
base rules refuse, and number formats that are no personal data set in the same contexts, are negatives. Secrets, which no base
rule knows, are taught by random values assigned to a secret's name, found in the corpus or set into its contexts, against digests,
addresses, versions and plain words there.

* Null or empty text: no span. Repeated rows and ids: each row for itself; a null id stays null.
* Base spans always stay; added spans never overlap a base span or each other. Ties go to the longer span, then the first.
* Without any base match in the sample there is nothing to learn from, and nothing is added.
* Other columns are not carried by ``find``; ``redact`` keeps all columns. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackstand.llm.common import narrow, small_batches, text_slices

KINDS = ("email", "ip", "card", "phone", "secret")
#: Kinds that base rules know; the last one comes from the trees alone.
BASE_KINDS = KINDS[:4]
#: Expected documents that training looks at, drawn by a hash of id and text.
SAMPLE_DOCS, ROUNDS, DEPTH, RATE, BINS = 6000, 40, 3, 0.3, 16
PRECISION = 0.98

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
ZONE = re.compile(r"[+(]?[0-9][0-9 ().+-]*")
AT = re.compile(r"(?:@| at | ?[\[(]at[\])] ?)[A-Za-z0-9-]+(?:(?:\.| dot | ?[\[(]dot[\])] ?)[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DIGITS = re.compile(r"[0-9]+")
LETTER = re.compile(r"[A-Za-z]")
ASSIGNED = re.compile(r"[:=]>?\s*[\"']?\Z")
RUN = re.compile(r"[A-Za-z0-9+/_=~.-]{16,}")
NAMED = re.compile(r"\b(?:[a-z]+[_-])?(?:api[ _-]?key|token|secret(?:[ _-]?key)?|private[ _-]?key|access[ _-]?key|passw(?:or)?d|pwd|passphrase|bearer|credentials?)\b"
                   r"[\"']?[ \t]{0,3}(?:[:=]>?)?[ \t]{0,3}[\"']?([^\s\"',;]{6,})", re.I)
LETTERS = re.compile(r"[A-Za-z]+")
_HEX = frozenset("0123456789abcdefABCDEF")
CUES = {k: re.compile(v, re.I) for k, v in {
    "phone": r"phone|tel\b|tel\.|call|fax|mobile|cell", "email": r"mail|contact|write|reach", "card": r"card|visa|credit|pay|account", "ip": r"\bip\b|host|server|addr|login",
    "secret": r"token|secret|passw|pwd|passphrase|api[ _-]?key|private[ _-]?key|access[ _-]?key|bearer|credential", "digest": r"\bsha|\bmd5|commit|hash|checksum|uuid|http|www|/",
    "other": r"order|invoice|\bid\b|ref|version|isbn|page|no\.|#|\bv[0-9]?\b"}.items()}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _emails(text: str):
    """Leftmost plain addresses; every one lies in a run of address signs around an @."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1] in _ADDRESS):
            start -= 1
        stop = at
        while stop < len(text) and text[stop] in _ADDRESS:
            stop += 1
        for m in EMAIL.finditer(text, start, stop):
            yield m.span()
        done = stop
        at = text.find("@", stop)


_ADDRESS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-@")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base rules, in order."""
    found = [(a, 0, b) for a, b in _emails(text)]
    for zone in ZONE.finditer(text):
        a, b = zone.span()
        if b - a < 7:
            continue
        for m in IP.finditer(text, a, b):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text, a, b):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text, a, b):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) proposals; spans and kinds may overlap."""
    out = set()
    for m in AT.finditer(text):
        local = LOCAL.search(text, max(0, m.start() - 64), m.start())
        if local:
            out.add((local.start(), 0, m.end()))
    for zone in ZONE.finditer(text):
        a, b = zone.span()
        while b > a and not text[b - 1].isdigit():
            b -= 1
        n = sum(c.isdigit() for c in text[a:b])
        if n < 4:
            continue
        runs = [(a, b)]
        for gap in re.finditer(r"(?<=[0-9])[ ().+-]*  [ ().+-]*(?=[0-9(+])|(?<=[0-9])[ .-]+(?=[+(])", text[a:b]):
            runs += [(a, a + gap.start()), (a + gap.end(), b)]
        for s, e in runs:
            k = sum(c.isdigit() for c in text[s:e])
            if 4 <= k <= 12 and len(DIGITS.findall(text, s, e)) == 4:
                out.add((s, 1, e))
            if 12 <= k <= 19:
                out.add((s, 2, e))
            if 7 <= k <= 15:
                out.add((s, 3, e))
    out.update((m.start(), 4, m.end()) for m in RUN.finditer(text) if DIGITS.search(m.group()) and LETTER.search(m.group()))
    out.update((m.start(1), 4, m.end(1)) for m in NAMED.finditer(text))
    return sorted(out)


def entropy(value: str) -> float:
    """Bits per sign."""
    counts = np.array(list(Counter(value).values()), float)
    return float(np.log2(len(value)) - (counts * np.log2(counts)).sum() / len(value)) if value else 0.0


def looks_random(value: str) -> bool:
    return len(value) >= 16 and entropy(value) >= 3 and DIGITS.search(value) is not None and LETTER.search(value) is not None


FEATURES = 34


def features(text: str, start: int, kind: int, end: int) -> list[float]:
    span = text[start:end]
    groups = [len(g) for g in DIGITS.findall(span)] or [0]
    digits = "".join(c for c in span if c.isdigit() and c.isascii())
    before, after = text[max(0, start - 32) : start], text[end : end + 32]
    around = before + " " + after
    edge = lambda c: 0 if not c or c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3
    return [kind, len(span), len(digits), sum(c.isalpha() for c in span), span.count(" "), span.count("-"), span.count("."), span.count("("), float(span[:1] == "+"), float(span[:2] == "00"),
            len(groups), max(groups), min(groups), groups[0], groups[-1], float(luhn(digits)) if len(digits) >= 12 else 0.0, float("@" in span), float(" dot " in span or "dot" in span.lower()),
            edge(before[-1:]), edge(after[:1]), sum(c.isdigit() for c in around), *[float(CUES[c].search(before) is not None) for c in ("phone", "email", "card", "ip", "other", "secret", "digest")],
            entropy(span), sum(any(map(f, span)) for f in (str.islower, str.isupper, str.isdigit)) + float(not span.isalnum()), float(not set(span) - _HEX),
            float(ASSIGNED.search(before) is not None), float(before[-1:] in ("'", '"')), max(map(len, LETTERS.findall(span)), default=0)]


def disguises(rng: random.Random, kind: int, span: str) -> list[str]:
    if kind == 0:
        local, _, domain = span.partition("@")
        return [f"{local} at {domain.replace('.', ' dot ')}", f"{local} (at) {domain.replace('.', ' (dot) ')}", f"{local}[at]{domain}"]
    if kind == 1:
        return [span.replace(".", "-"), span.replace(".", " . ")]
    if kind == 2:
        d = re.sub(r"[^0-9]", "", span)
        return [".".join(d[i : i + 4] for i in range(0, len(d), 4)), "  ".join(d[i : i + 4] for i in range(0, len(d), 4))]
    rest = re.sub(r"^\+[0-9]{1,3}[ .-]*", "", span)
    return [rest, "00" + span[1:], rest.replace("(", "").replace(")", "")]


def decoys(rng: random.Random, kind: int, span: str) -> list[str]:
    """Formats that are no personal data, with fresh digits."""
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    year = f"{rng.randint(1900, 2030)}"
    out = [f"{year}-{rng.randint(10, 12)}-{rng.randint(10, 28)} {n(2)}.{n(2)}", f"{year}-{year}", n(rng.randint(7, 11)), f"{n(1)}.{n(2)}.{n(1)}.{n(4)}", f"{n(3)} {n(3)} {n(3)}"]
    if kind == 0:
        out += [f"look at {rng.choice(['noon', 'home', 'work'])} dot", "meet at place dot com"[: rng.randint(12, 21)]]
    if kind == 2:
        d = re.sub(r"[^0-9]", "", span)
        out += [d[:-1] + str((int(d[-1]) + rng.randint(1, 9)) % 10), n(len(d))]
    return out


#: Ways in which secrets are written, and texts that only look like them.
NAMES = ("api_key", "apikey", "token", "access_token", "auth_token", "secret", "client_secret", "secret_key", "password", "passwd", "private_key")
ASSIGNMENTS = ('{n} = "{v}"', "{n}: {v}", "{n}={v}", '"{n}": "{v}"', "{n} = '{v}'", "Authorization: Bearer {v}", "--{n} {v}", "my {n} is {v}")
LOOKALIKES = ("sha256: {hex}", "commit {hex}", "md5 {hex}", "checksum={hex}", "https://files.example/{word}/{hex}", "uuid {uuid}", "{n} = required", "{n}: {word}",
              "the {n} {word} was", "{word}-{word}-2021-{word}", "build-{num}.{num}-{word}-release", "{word}_{word}_{num}_{word}", "see http://www.example/{word}/2020/{word}.html")


def made_secret(rng: random.Random) -> str:
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    mixed = lower + lower.upper() + digits
    draw = lambda signs, k: "".join(rng.choice(signs) for _ in range(k))
    return rng.choice([
        lambda: draw(digits + "abcdef", rng.choice((32, 40, 64))), lambda: draw(digits + "ABCDEF", rng.choice((32, 40))), lambda: draw(mixed, rng.randint(20, 44)),
        lambda: draw(mixed + "+/", rng.choice((27, 43))) + "=", lambda: f"sk_live_{draw(mixed, 24)}", lambda: f"AKIA{draw(lower.upper() + digits, 16)}",
        lambda: ".".join((draw(mixed, 20), draw(mixed + "_-", 40), draw(mixed + "_-", 43))), lambda: draw(lower, 4) + draw(digits, 3) + draw("!#$%&*", 2) + draw(mixed, 3)])()


def secret_examples(rng: random.Random, before: str, after: str) -> list[tuple[list[float], int]]:
    """Made secrets and lookalikes between two pieces of a text."""
    out = []
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(4, 12)))
    for _ in range(2):
        value, name = made_secret(rng), rng.choice(NAMES)
        made = rng.choice(ASSIGNMENTS).format(n=rng.choice((name, name.upper(), name.replace("_", "-"))), v=value)
        changed, at = before + made + after, len(before) + made.rindex(value)
        out += [(features(changed, s, k, e), 1) for s, k, e in candidates(changed) if (s, k, e) == (at, 4, at + len(value))]
    for _ in range(3):
        hexes = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice((32, 40, 64))))
        uuid = "-".join(hexes[a:b] for a, b in ((0, 8), (8, 12), (12, 16), (16, 20), (20, 32)))
        made = rng.choice(LOOKALIKES).format(n=rng.choice(NAMES), hex=hexes, uuid=uuid, word=word(), num=rng.randint(1, 99))
        changed = before + made + after
        out += [(features(changed, s, k, e), 0) for s, k, e in candidates(changed) if k == 4 and len(before) <= s and e <= len(before) + len(made)]
    return out


def examples(text: str) -> list[tuple[list[float], int]]:
    """(features, label) of a text's candidates, as they stand, disguised and replaced."""
    seed = len(text) * 1_000_003 + sum(map(ord, text[:64]))
    rng, own = random.Random(seed), random.Random(seed + 1)
    base, out = base_spans(text), []
    held = {(a, k, b) for a, k, b in base}
    named = {m.span(1): ASSIGNED.search(text, max(0, m.start(1) - 4), m.start(1)) and looks_random(m.group(1)) for m in NAMED.finditer(text)}
    for a, k, b in candidates(text):
        if k == 4 and ((a, b) in named or CUES["secret"].search(text, max(0, a - 32), a)):
            if named.get((a, b)):  # values named otherwise may be secrets or not: they teach nothing
                out.append((features(text, a, k, b), 1))
        elif (a, k, b) in held:
            out.append((features(text, a, k, b), 1))
        elif not any(x < b and a < y for x, _, y in base):
            out.append((features(text, a, k, b), 0))
    for a, _, b in base[:3]:
        out += secret_examples(own, text[max(0, a - 80) : a] + " ", " " + text[b : b + 80])
    for a, k, b in base[:20]:
        for made, label in [(x, 1) for x in disguises(rng, k, text[a:b])] + [(x, 0) for x in decoys(rng, k, text[a:b])]:
            changed = text[max(0, a - 80) : a] + made + text[b : b + 80]
            at = min(a, 80)
            for s, kind, e in candidates(changed):
                if label and kind == k and s <= at + 1 and e >= at + len(made) - 1:
                    out.append((features(changed, s, kind, e), 1))
                elif not label and s < at + len(made) and at < e:
                    out.append((features(changed, s, kind, e), 0))
    return out


class Trees:
    """Boosted trees of fixed depth on binned features, logistic loss."""

    def __init__(self, cuts, trees, bias, thresholds, secrets: Trees | None = None):
        self.cuts, self.trees, self.bias, self.thresholds, self.secrets = cuts, trees, bias, thresholds, secrets

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, k], "right") for k, c in enumerate(self.cuts)], 1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        b, z = self.bins(x), np.full(len(x), self.bias)
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), int)
            for level in range(DEPTH):
                k = (1 << level) - 1 + node
                node = node * 2 + (b[np.arange(len(x)), feature[k]] > cut[k])
            z += leaf[node]
        p = 1 / (1 + np.exp(-z))
        own = x[:, 0] == 4
        if self.secrets is not None and own.any():
            p[own] = self.secrets.probability(x[own])
        return p


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees for candidates of the base kinds, with trees of their own for secrets."""
    own = x[:, 0] == 4
    model = _boost(x[~own], y[~own])
    model.secrets = _boost(x[own], y[own])
    return model


def _boost(x: np.ndarray, y: np.ndarray) -> Trees:
    if not len(x):
        return Trees([np.zeros(0)] * FEATURES, [], -9.0, [2.0] * len(KINDS))
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS)))[1:] for k in range(x.shape[1])]
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Trees(cuts, [], float(np.log(mean / (1 - mean))), [2.0] * len(KINDS))
    b, z = model.bins(x), np.full(len(x), model.bias)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(x), int)
        feature, cut = np.zeros((1 << DEPTH) - 1, int), np.full((1 << DEPTH) - 1, BINS)
        for level in range(DEPTH):
            width = 1 << level
            gains = np.zeros((width, x.shape[1], BINS))
            for k in range(x.shape[1]):
                at = node * BINS + b[:, k]
                gs, hs = (np.bincount(at, v, width * BINS).reshape(width, BINS).cumsum(1) for v in (g, h))
                gt, ht = gs[:, -1:], hs[:, -1:]
                gains[:, k] = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
            best = gains.reshape(width, -1).argmax(1)
            k = np.arange(width) + width - 1
            feature[k], cut[k] = best // BINS, best % BINS
            node = node * 2 + (b[np.arange(len(x)), feature[width - 1 + node]] > cut[width - 1 + node])
        leaf = -RATE * np.bincount(node, g, 1 << DEPTH) / (np.bincount(node, h, 1 << DEPTH) + 1)
        z += leaf[node]
        model.trees.append((feature, cut, leaf))
    return model


def calibrate(model: Trees, x: np.ndarray, y: np.ndarray) -> None:
    """Per kind the lowest threshold above which held-out candidates are right as often as asked."""
    p = model.probability(x)
    for k in range(len(KINDS)):
        own = x[:, 0] == k
        order = np.argsort(-p[own], kind="stable")
        right = np.cumsum(y[own][order]) / np.arange(1, order.size + 1)
        good = np.flatnonzero(right >= PRECISION)
        good = good[good >= 19]  # fewer held-out candidates prove nothing
        model.thresholds[k] = max(0.5, float(p[own][order][good[-1]])) if len(good) else 2.0


def _examples(batches):
    for batch in batches:
        for piece in text_slices(batch):
            rows = [r for t in piece.column("text").to_pylist() if t for r in examples(t)]
            x = np.array([r for r, _ in rows], np.float32).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([np.array([y for _, y in rows], np.int8).tobytes()], pa.binary())], ["x", "y"])


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", docs: int = SAMPLE_DOCS) -> Trees | None:
    rows = narrow(df, id_col, text_col)
    share = min(1.0, docs / max(1, rows.count()))
    drawn = rows.where(F.pmod(F.xxhash64(F.lit(11), "doc_id", "text"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    drawn = drawn.where(F.col("text").rlike("[0-9]{2}")).select("text", F.pmod(F.xxhash64("text"), F.lit(4)).alias("part"))
    sets = []
    for side in (drawn.where("part <> 0"), drawn.where("part = 0")):
        got = side.select("text").mapInArrow(_examples, "x binary, y binary").toArrow()
        x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(-1, FEATURES).astype(float)
        y = np.frombuffer(b"".join(got.column("y").to_pylist()), np.int8).astype(float)
        sets.append((x, y))
    (x, y), held = sets
    if not y.any() or y.all():
        return None
    order = np.lexsort(x.T)  # the fit does not depend on the order in which tasks end
    model = boost(x[order], y[order])
    calibrate(model, *held)
    return model


def spans(text: str, model: Trees | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and the spans added by the trees."""
    base = base_spans(text)
    if model is None:
        return base, []
    free, covered = [], 0
    marks = sorted((a, b) for a, _, b in base)
    for a, k, b in candidates(text):
        while covered < len(marks) and marks[covered][1] <= a and marks[covered][0] < a:
            covered += 1
        if not any(s < b and a < e for s, e in marks[covered:covered + 8]):
            free.append((a, k, b))
    if not free:
        return base, []
    p = model.probability(np.array([features(text, *c) for c in free], float))
    added: list[tuple[int, int, int]] = []
    taken: list[tuple[int, int]] = []
    for i in sorted(range(len(free)), key=lambda i: (-p[i], free[i][0] - free[i][2], free[i])):
        a, k, b = free[i]
        if p[i] >= model.thresholds[k] and not any(s < b and a < e for s, e in taken):
            taken.append((a, b))
            added.append(free[i])
    return base, sorted(added)


def name_spans(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


#: Stands in every text that has a candidate of a base kind.
_MAY_HOLD = re.compile(r"@|[0-9][0-9 ().+-]{4}|[\[(]at[\])]| dot | at [A-Za-z0-9-]+(?:\.| ?[\[(]dot)")


def may_hold(text: str) -> bool:
    return _MAY_HOLD.search(text) is not None or RUN.search(text) is not None or NAMED.search(text) is not None


def _find(model):
    names = ["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "n_added", "n_secret", "n_spans"]
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches):
        trees = model.value
        for batch in batches:
            for piece in text_slices(batch):
                rows = []
                for t in piece.column("text").to_pylist():
                    if not t or not may_hold(t):
                        rows.append((0, 0, 0, 0, nothing, "", 0, 0, 0))
                        continue
                    base, added = spans(t, trees)
                    counts = [sum(k == x for _, k, _ in base) for x in range(len(BASE_KINDS))]
                    more = (len(added), sum(k == 4 for _, k, _ in added), len(base) + len(added))
                    rows.append((*counts, hashlib.sha256(name_spans(base).encode()).hexdigest(), name_spans(base + added), *more))
                kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), *[pa.int64()] * 3]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *[pa.array(c, t) for c, t in zip(zip(*rows), kinds)]], names)

    return run


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Trees | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base), base_sha256, spans (base and added), n_added, n_secret, n_spans."""
    held = df.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_secret long, n_spans long"
    return narrow(df, id_col, text_col).mapInArrow(_find(held), schema)


def redacted(text: str | None, model: Trees | None) -> str | None:
    if not text or not may_hold(text):
        return text
    base, added = spans(text, model)
    out, at = [], 0
    for a, k, b in sorted(base + added):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _redact(model, text_col: str):
    def run(batches):
        trees = model.value
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for piece in text_slices(batch, text_col):
                texts = pa.array([redacted(t, trees) for t in piece.column(at).to_pylist()], piece.schema.field(at).type)
                yield pa.RecordBatch.from_arrays([texts if k == at else piece.column(k) for k in range(piece.num_columns)], schema=piece.schema)

    return run


def redact(df: DataFrame, model: Trees | None, text_col: str = "text") -> DataFrame:
    """``df`` with each span replaced by its kind in brackets; overlapping spans give one sign, that of the first."""
    small_batches(df.sparkSession)
    return df.mapInArrow(_redact(df.sparkSession.sparkContext.broadcast(model), text_col), df.schema)


def digest(df: DataFrame) -> DataFrame:
    return find(df, model=fit(df))

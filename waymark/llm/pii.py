"""PII spans: high-recall generators, boosted trees over format and context, calibrated thresholds.

Fixed formats (e-mail, ip, card, phone) are always taken. Beside them, generators propose
overlapping spans of looser forms: spelled-out e-mail addresses, phone numbers without a plus,
national ids, bank accounts and labelled account numbers. Each span gets features of its format
(digits, groups, separators, check digits) and its context (label words and characters on both
sides); boosted trees score it; a threshold per kind, calibrated on held-out spans for PRECISION,
decides; overlapping accepted spans are resolved by probability.

The trees are trained on TRAIN spans that `examples` writes from a fixed seed: no corpus row is
read for training, so nothing grows with the input.

Parameters of the loose forms (GENERATORS): a spelled-out address has 64 characters before the sign
and 63 in a label at most, a national number 11 digits or 3-2-4, an account 6 to 12. Fixed formats
have no such bounds.

Defined cases: a null or empty text has no spans; a null id stays null; repeated rows are scanned
one by one; of overlapping proposals the likelier one is taken, of equally likely ones the first
kind, then the first place; other columns, also such as are named like ours, are ignored; an empty
table gives no rows; time is linear in the text but for sorting its proposals, at any length.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from . import textvec as tv
from .common import arrow, id_column
from .gbdt import Boosted, Isotonic

KINDS = ("email", "ip", "card", "phone", "email_spelled", "phone_local", "national_id", "iban", "account")
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
TRAIN, PRECISION = 6000, 0.97
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
GENERATORS = {
    4: re.compile(r"(?<![\w.+-])[\w.+-]{1,64} ?(?:@|\(at\)|\[at\]) ?[\w-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[\w-]{1,63}){1,6}", re.A),
    5: re.compile(r"(?<![\w+.-])\(?[0-9]{2,5}\)?(?:[ ./-]?\(?[0-9]{2,5}\)?){1,5}(?![\w-])", re.A),
    6: re.compile(r"(?<![\w-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![\w-])|(?<!\w)[0-9]{11}(?!\w)", re.A),
    7: re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)", re.A),
    8: re.compile(r"(?<!\w)[A-Z]{0,2}[0-9]{6,12}(?!\w)", re.A),
}
CUES = (("mail", "contact", "write"), ("phone", "tel", "call", "mobile", "fax", "number is", "reach me", "text me", "whatsapp", "dial"), ("ssn", "social", "national", "oib", "passport", "id no"), ("iban", "bank", "account", "acct"), ("order", "invoice", "total", "price", "page", "version", "isbn", "year", "ticket", "ref", "eur", "usd"))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of local@domain, found from the @ signs, so long words cost no retries."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        nxt = at + 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            done = nxt = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", nxt)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed formats, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if "." in text:
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() and 13 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return out


def proposals(text: str) -> list[tuple[int, int, int]]:
    """Overlapping candidate spans of the loose forms."""
    return [(k, m.start(), m.end()) for k, p in GENERATORS.items() if k != 4 or "@" in text or "at" in text for m in p.finditer(text)]


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    s, before, after = text[start:end], text[max(0, start - 32) : start].lower(), text[end : end + 12].lower()
    digits = [c for c in s if "0" <= c <= "9"]
    groups = re.findall(r"[0-9]+", s)
    letters = sum(c.isalpha() for c in s)
    mod97 = 0.0
    if kind == 7:
        plain = s.replace(" ", "")
        moved = plain[4:] + plain[:4]
        mod97 = float(all(c.isascii() and c.isalnum() for c in moved) and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1)
    near = [float(min((len(before) - before.rfind(w) for w in cue if w in before), default=64)) for cue in CUES]
    return [
        *(float(kind == k) for k in GENERATORS), float(len(s)), float(len(digits)), float(letters), float(len(groups)), float(max(map(len, groups), default=0)), float(min(map(len, groups), default=0)),
        float(s.count("-")), float(s.count(" ")), float(s.count(".")), float(s.count("/")), float("(" in s), float("@" in s or "(at)" in s or "[at]" in s), float(bool(groups) and groups[0].startswith("0")), float(luhn("".join(digits)) if digits else 0),
        mod97, *near, float(before[-1:].isalnum()), float(after[:1] in "%$€°"), float(before.rstrip()[-1:] in (":", "=")), float(any(w in after for w in (" eur", " usd", " km", " kg", "%"))), float(len(set(digits))),
    ]


def examples(n: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and kinds of n written spans: personal ones under fitting labels, and look-alikes."""
    r = random.Random(seed)
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice(("ba", "ton", "re", "mi", "sol", "ven", "ka", "st")) for _ in range(r.randint(1, 4)))
    fill = lambda k: " ".join(word() for _ in range(k))

    def iban() -> str:
        country, body = r.choice(("DE", "FR", "HR", "GB", "ES")), num(r.choice((16, 18, 20)))
        check = 98 - int(body + str(int(country[0], 36)) + str(int(country[1], 36)) + "00") % 97
        return f"{country}{check:02d}{body}"

    good = {
        4: lambda: (r.choice(("mail me at", "contact:", "write to", "e-mail", "")), f"{word()}.{word()}{r.choice((' (at) ', '(at)', ' [at] '))}{word()}{r.choice((' (dot) ', '.', ' [dot] '))}{r.choice(('com', 'org', 'net'))}"),
        5: lambda: (r.choice(("call", "phone:", "tel.", "mobile", "fax", "Tel:", "my number is", "reach me on", "text me at", "dial")), r.choice((f"0{num(2)}/{num(3)}-{num(4)}", f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}", f"{num(3)} {num(3)} {num(4)}", f"{num(3)}.{num(3)}.{num(4)}", f"0{num(2)} {num(4)} {num(3)}"))),
        6: lambda: (r.choice(("SSN", "social security", "national id", "OIB:", "passport", "ssn is")), r.choice((f"{num(3)}-{num(2)}-{num(4)}", num(11)))) if r.random() < 0.7 else (fill(1), f"{num(3)}-{num(2)}-{num(4)}"),
        7: lambda: (r.choice(("IBAN", "bank", "account", "pay to")), iban()),
        8: lambda: (r.choice(("account no", "acct:", "passport no", "bank account")), r.choice((num(9), "AB" + num(7), num(10)))),
    }
    bad = {
        4: lambda: (fill(1), f"{word()} @ {num(1)}.{num(2)}"),
        5: lambda: (r.choice(("order", "page", "version", "in", "total", fill(1))), r.choice((f"{r.randint(1900, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}", f"{num(2)}.{num(2)}", f"{num(3)} {num(3)}", f"{r.randint(1900, 2030)}-{r.randint(1900, 2030)}", f"{num(2)}/{num(2)}/{num(4)}", f"{num(3)}-{num(3)}-{num(4)}"))) if r.random() < 0.8 else (r.choice(("SSN", "ssn", "social security", fill(1))), f"{num(3)}-{num(2)}-{num(4)}"),
        6: lambda: (r.choice(("order", "invoice", "ref", "ticket", fill(1))), r.choice((f"{num(3)} {num(2)} {num(4)}", num(11)))),
        7: lambda: (r.choice(("part", "ref", fill(1))), f"{r.choice(('DE', 'XQ', 'ZZ'))}{num(2)}{num(r.choice((8, 12, 16)))}"),
        8: lambda: (r.choice(("order", "invoice", "ref", "ticket", "isbn", fill(1))), num(r.randint(6, 12))),
    }
    x, y, kinds = [], [], []
    while len(y) < n:
        label = len(y) % 2
        kind = r.choice(list(GENERATORS))
        cue, span = (good if label else bad)[kind]()
        lead = f"{fill(r.randint(1, 5))} {cue} "
        text = f"{lead}{span}{r.choice((' ', '. ', ', '))}{fill(3)}"
        x.append(features(text, kind, len(lead), len(lead) + len(span)))
        y.append(label)
        kinds.append(kind)
    return np.array(x), np.array(y), np.array(kinds)


@lru_cache(maxsize=1)
def model() -> tuple[Boosted, Isotonic, dict[int, float]]:
    """Trees from two thirds of the spans; calibration and a threshold per kind from the others."""
    x, y, kinds = examples(TRAIN)
    cut = TRAIN * 2 // 3
    trees = Boosted().fit(x[:cut], y[:cut])
    score = trees.score(x[cut:])
    limits = {k: Isotonic().fit(score[own], y[cut:][own]).threshold(PRECISION) for k in GENERATORS if (own := kinds[cut:] == k).any()}
    return trees, Isotonic().fit(score, y[cut:]), limits


class Spans:
    """Disjoint spans in order; overlapping ones that are added in order of their starts are joined."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def free(self, a: int, b: int) -> bool:
        k = bisect_right(self.ends, a)
        return k == len(self.starts) or self.starts[k] >= b

    def add(self, a: int, b: int) -> None:
        k = bisect_left(self.starts, a)
        if k and self.ends[k - 1] > a:
            self.ends[k - 1] = max(self.ends[k - 1], b)
        else:
            self.starts.insert(k, a)
            self.ends.insert(k, b)


def added_spans(text: str, base: list[tuple[int, int, int]], trained) -> list[tuple[int, int, int]]:
    """Accepted proposals that overlap neither fixed formats nor likelier ones."""
    trees, calibrated, limits = trained
    covered = Spans()
    for _, a, b in sorted(base, key=lambda x: x[1]):
        covered.add(a, b)
    found = [p for p in proposals(text) if covered.free(p[1], p[2])]
    if not found:
        return []
    score = trees.score(np.array([features(text, *p) for p in found]))
    sure = calibrated(score)
    taken: list[tuple[int, int, int]] = []
    for _, _, p in sorted((-q, -s, p) for q, s, p in zip(sure, score, found, strict=True) if s >= limits[p[0]]):
        if covered.free(p[1], p[2]):
            covered.add(p[1], p[2])
            taken.append(p)
    return taken


def show(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


_EMPTY = hashlib.sha256(b"").hexdigest()
_MARK = np.zeros(256, np.int64)
_MARK[list(b"0123456789@")] = 1
_MARK[list(b"([")] = 1


def scan_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with counts, the digest of the fixed formats' spans, and all spans; no shuffle."""
    trained = model()

    def run(batches):
        for batch in batches:
            ids, texts = id_column(batch, "doc_id"), batch.column(1)
            for first, end, data, offsets in tv.slices(batch):
                marks = np.concatenate([[0], np.cumsum(_MARK[data])])
                marked = marks[offsets[1:]] > marks[offsets[:-1]]
                rows = []
                for r in range(end - first):
                    if not marked[r]:
                        rows.append((0, 0, 0, 0, _EMPTY, "", 0))
                        continue
                    text = texts[first + r].as_py() or ""
                    base = base_spans(text)
                    added = added_spans(text, base, trained)
                    rows.append((*(sum(x[0] == k for x in base) for k in range(4)), hashlib.sha256(show(base).encode()).hexdigest(), show(sorted(base + added)), len(added)))
                cols = list(map(list, zip(*rows, strict=True)))
                yield arrow(SCHEMA, doc_id=ids.slice(first, end - first), n_email=cols[0], n_ip=cols[1], n_card=cols[2], n_phone=cols[3], base_sha256=cols[4], spans=cols[5], n_added=cols[6])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, SCHEMA)

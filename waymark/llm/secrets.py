"""Secret scans: fixed formats, then sliding-window entropy over candidate strings.

Candidates are runs of at least MIN_RUN characters of a token alphabet. Each is classed by the
characters in it; a window of WINDOW characters slides over it, its character counts are kept by
adding one character and taking away another, and sum(c * log2 c) changes with them, so each step
costs two table look-ups. A candidate is a secret if a window's Shannon entropy reaches its class's
limit; what an allow rule covers (dates, ids, placeholders, one character over and over, ascending
rows) is cut out first, so it suppresses the windows that touch it and not the rest of a candidate,
and so are pieces that read like words, also with separators, numbers or dates between them. Paths and URLs are judged part by part, and a candidate
beside a fixed format by what is left of it. MIN_RUN is the least length of a candidate: shorter
keys are found by the fixed formats only.

Defined cases: a null or empty text has no spans; a null id stays null; repeated rows are scanned
one by one; other columns, also such as are named like ours, are ignored; an empty table gives no
rows; equal spans of several kinds are all reported; time is linear in the text, of any length.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
from pyspark.sql import DataFrame

from . import textvec as tv
from .common import arrow, id_column

KINDS = ("assign", "access", "hex", "entropy")
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long"
_ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
MIN_RUN, WINDOW = 20, 20
#: Least entropy in bits of a window of 20 characters, by class: (upper, lower, digit) present, or a symbol of base64.
LIMITS = {"digits": 2.7, "hexadecimal": 3.1, "one_case": 3.3, "one_case_digits": 3.5, "two_cases": 3.6, "mixed": 3.6, "base64": 3.6}
_LOG = [0.0] + [k * math.log2(k) for k in range(1, WINDOW + 1)]
ALLOWED = [re.compile(p) for p in (r"(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", r"(?i)example|placeholder|changeme|your[-_]", r"(.)\1{5,}", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}", r"^[-_.=+/]+$")]
#: Characters in a row that make an ascending one, such as 0123456 or abcdef.
ASCENDING = 5
#: Words between separators, each with digits at one end at most or none: names of things, numbered or dated. Keys mix letters and digits more than once.
_NAMES = re.compile(r"[-_./=+]*([A-Za-z]+[0-9]*|[0-9]+[A-Za-z]*)([-_./=+]+([A-Za-z]+[0-9]*|[0-9]+[A-Za-z]*))*[-_./=+]*")
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_PLAIN = re.compile(r"[A-Za-z]+([-_.][A-Za-z0-9]+)*|v?[0-9.]{1,4}")
#: Pairs of letters that are common in words; of random pairs two in five are among them.
_PAIRS = set("th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur ca el ta la ns di fo ho pe ec pr no ct us ac ot il tr ly nc et ut ss so rs un lo wa ge ie wh ee wi em ad ol rt po we na ul ni ts mo ow pa im mi ai sh ir su id os iv ia am fi ci vi pl ig tu ev ld ry mp fe bl ab gh ty op wo sa ay ex ke fr oo av ag if ap gr od bo sp rd do uc bu ei ov by rm ep tt oc fa ef cu rn sc gi da yo cr cl du ga qu ue ff ba ey ls va um pp ua up lu go ht ru ug ds lt pi rc rr eg au ck ew mu br bi pt ak pu ui rg ib tl ny ki rk ys ob mm fu ph og ms ye ud mb ip ub oi rl gu dr hr cc tw ft wn nu af hu nn eo vo rv nf xp gn sm fl iz ok my gl aw ju oa sy sl ps jo lf nv je nk kn gs dy hy ze ks".split())
_TOKEN, _HEX = np.zeros(256, bool), np.zeros(256, bool)
_TOKEN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-")] = True
_HEX[list(b"0123456789abcdef")] = True


def runs(mask: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs inside a row that have at least so many bytes."""
    n = len(mask)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(mask & (edge[:n] | ~np.concatenate([[False], mask[:-1]])))
    end = np.flatnonzero(mask & (edge[1:] | ~np.concatenate([mask[1:], [False]]))) + 1
    long = end - start >= least
    return start[long], end[long]


def char_class(s: str) -> str:
    upper, lower, digit = any("A" <= c <= "Z" for c in s), any("a" <= c <= "z" for c in s), any("0" <= c <= "9" for c in s)
    if re.fullmatch(r"[0-9]+", s):
        return "digits"
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", s):
        return "hexadecimal"
    if any(c in "+/=" for c in s) and upper and lower and digit:
        return "base64"
    return "mixed" if upper and lower and digit else "two_cases" if upper and lower else "one_case_digits" if digit else "one_case"


def window_entropy(s: str, width: int = WINDOW) -> float:
    """Greatest Shannon entropy in bits of a window, by counts that change with the window."""
    width = min(width, len(s))
    if not width:
        return 0.0
    counts: dict[str, int] = {}
    weight = 0.0
    least = math.inf
    for i, c in enumerate(s):
        k = counts.get(c, 0)
        counts[c] = k + 1
        weight += _LOG[k + 1] - _LOG[k] if k < WINDOW else 0.0
        if i >= width:
            k = counts[gone := s[i - width]]
            counts[gone] = k - 1
            weight += _LOG[k - 1] - _LOG[k]
        if i >= width - 1:
            least = min(least, weight)
    return math.log2(width) - least / width


def natural(s: str) -> bool:
    """Whether the letters of a string form words: pieces of three letters in the mean, made of common pairs."""
    pieces = _PIECE.findall(s)
    pairs = [p[k : k + 2].lower() for p in pieces for k in range(len(p) - 1)]
    return sum(map(len, pieces)) >= 3 * len(pieces) and sum(x in _PAIRS for x in pairs) >= 0.7 * len(pairs)


def _named(s: str) -> bool:
    """Whether a piece is a name: its letters are most of it and form words, and digits stand beside them in blocks."""
    letters = sum(c.isalpha() for c in s)
    return 2 * letters >= sum(c.isalnum() for c in s) > 0 and _NAMES.fullmatch(s) is not None and natural(s)


def _ascending(s: str) -> list[tuple[int, int]]:
    """Spans of at least ASCENDING characters each of which follows the one before it."""
    cuts = [0, *(k for k in range(1, len(s)) if ord(s[k]) != ord(s[k - 1]) + 1), len(s)]
    return [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b - a >= ASCENDING]


def _dense(s: str) -> bool:
    """Whether a window outside the allowed spans reaches the limit of the class of its piece."""
    covered = sorted([m.span() for p in ALLOWED for m in p.finditer(s)] + _ascending(s))
    at = 0
    for a, b in [*covered, (len(s), len(s))]:
        piece = s[at:a]
        if len(piece) >= WINDOW and not _named(piece) and window_entropy(piece) >= LIMITS[char_class(piece)]:
            return True
        at = max(at, b)
    return False


def secret_parts(s: str) -> list[tuple[int, int]]:
    """Spans of the secrets in a candidate: the whole, or parts of a path or URL."""
    parts = [(m.start(), m.end()) for m in re.finditer("[^/]+", s)]
    plain = sum(bool(_PLAIN.fullmatch(s[a:b])) and natural(s[a:b]) for a, b in parts)
    if s.startswith("//") or "/" in s and 2 * plain >= len(parts):
        return [(a, b) for a, b in parts if b - a >= MIN_RUN and _dense(s[a:b])]
    return [(0, len(s))] if _dense(s) else []


def is_secret(s: str) -> bool:
    return bool(secret_parts(s))


def scan(text: str, hexes: list[tuple[int, int]], candidates: list[tuple[int, int]]) -> tuple[list, list]:
    """Base spans and added ones; hexes and candidates are given as runs in code points."""
    base = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        base += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    base = sorted(base + [(a, 2, b) for a, b in hexes])
    # what the base spans cover, as disjoint spans in order; candidates come in order too
    covered: list[list[int]] = []
    for x, _, y in base:
        if covered and x <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], y)
        else:
            covered.append([x, y])
    added, k = [], 0
    for a, b in candidates:
        while k < len(covered) and covered[k][1] <= a:
            k += 1
        j = k
        while True:
            x, y = covered[j] if j < len(covered) and covered[j][0] < b else (b, b)
            if x - a >= MIN_RUN:
                added += [(a + i, 3, a + e) for i, e in secret_parts(text[a:x])]
            a, j = max(a, y), j + 1
            if x == b or a >= b:
                break
    return base, added


def show(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _rows(batch):
    ids, texts = id_column(batch, "doc_id"), batch.column(1)
    for first, end, data, offsets in tv.slices(batch):
        points = tv.code_points(data)
        found: dict[int, tuple[list, list]] = {}
        for k, (mask, least) in enumerate(((_HEX, 24), (_TOKEN, MIN_RUN))):
            start, stop = runs(mask[data], offsets, least)
            row = np.searchsorted(offsets, start, "right") - 1
            zero = points[offsets[row]]
            for r, a, b in zip(row.tolist(), (points[start] - zero).tolist(), (points[stop] - zero).tolist(), strict=True):
                found.setdefault(r, ([], []))[k].append((a, b))
        out = []
        for r in range(end - first):
            base, added = scan(texts[first + r].as_py() or "", *found.get(r, ([], [])))
            n = [sum(x[1] == k for x in base) for k in range(3)]
            out.append((*n, hashlib.sha256(show(base).encode()).hexdigest(), show(sorted(base + added)), len(added)))
        cols = list(map(list, zip(*out, strict=True)))
        yield arrow(SCHEMA, doc_id=ids.slice(first, end - first), n_assign=cols[0], n_access=cols[1], n_hex=cols[2], base_sha256=cols[3], spans=cols[4], n_entropy=cols[5])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with counts, the digest of the base spans, and all spans; a map without a shuffle."""

    def run(batches):
        for batch in batches:
            yield from _rows(batch)

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, SCHEMA)

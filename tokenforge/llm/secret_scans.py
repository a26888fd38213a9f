"""Secret scans with a battery of randomness tests (operator 10).

Fixed patterns find assignments, access keys and hex runs.  Beside them, every run of 20 or more encoding characters
is tested: its encoding is inferred from the characters present, and three statistics are compared with what text of
the same length and encoding would give.  Chi-squared: letters spread over the alphabet more evenly than those of text.
Runs: upper case, lower case and digits change more often.  Lag-one serial correlation of vowels against consonants: they
alternate less.  Each has a tail probability under "this is text"; their normal scores are added, with an allowance for
correlation.  The same tests in the other direction must not contradict independent uniform characters, so alphabets in
order and other regular strings fall out.  The p-values of one document go through a Benjamini-Hochberg rule with
weights that grow with the run's length.  A run that is not found as a whole, such as a value glued to a name or path by
``=``, ``/``, ``_``, ``-`` or ``+``, goes through the rule again, first cut at ``=``, then as its words and their ranges.
No document needs another, so the scan moves no rows.

Defined cases: null and empty texts have no spans; rows repeat as they do in the input; an empty table gives an
empty result; other columns are ignored by the scan and kept by the redaction.  Positions are code points, ends
exclusive; a span is the whole match.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import textkit as tk
from .shared import spread, table

KINDS = ("assign", "access", "hex", "random")


def _either_case(words: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


_ASSIGN = re.compile(
    "(" + _either_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]+")
_RUN = re.compile("[A-Za-z0-9+/_=-]+")
_WORD = re.compile("[A-Za-z0-9]+")
_GROUPED = re.compile("(?<![A-Za-z0-9])[0-9a-fA-F]+(?:-[0-9a-fA-F]+)+(?![A-Za-z0-9])")
#: The signs of base64 and of its URL-safe form.
_ALNUM, _JOINTS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", ("+/", "-_")
_HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key", b"akia")
LEAST_HEX, LEAST_RUN = 16, 20
#: Letters or pairs that a test needs.
LEAST_TESTED = 6
#: Text changes between cases and digits at these shares of pairs at most (in mixed case, as joined names do, and in one
#: case with numbers), and turns between vowels and consonants at this share at least.
TEXT_TURNS, TEXT_TURNS_ONE_CASE, TEXT_ALTERNATES = 0.25, 0.1, 0.6
#: Correlation between two tests' scores that is allowed for.
TOGETHER = 0.15
#: The share of false ones among a document's discoveries.
RATE = 0.01
_NORMAL = NormalDist()
#: Letter frequencies of text in Latin script, in percent, from a to z (rounded means over European languages).
_FREQUENT = dict(zip("abcdefghijklmnopqrstuvwxyz", (8.8, 1.4, 3.3, 4.2, 14.0, 1.3, 1.6, 2.6, 7.3, 0.4, 0.6, 4.6, 2.7, 7.8, 6.3, 2.2, 0.5, 6.8, 6.9, 7.5, 4.0, 1.2, 1.2, 0.3, 0.9, 0.6), strict=True))


def _tail(z: float) -> float:
    """Two-sided normal tail."""
    return math.erfc(abs(z) / math.sqrt(2))


def _chi2_tail(x: float, df: int) -> float:
    """Upper tail of chi-squared (Wilson-Hilferty)."""
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def encoding(run: str) -> tuple[str, str] | None:
    """The alphabet that the characters of ``run`` suggest, as (name, alphabet), or None for plain digits."""
    upper, lower, digit = (bool(re.search(p, run)) for p in ("[A-Z]", "[a-z]", "[0-9]"))
    low, up, dig = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", run) and (upper or lower):
        return "hex", dig + ("ABCDEF" if upper else "abcdef")
    if upper and not lower and re.fullmatch("[A-Z2-7]+", run) and digit:
        return "base32", up + "234567"
    if upper and lower:
        if re.search("[+/]", run):
            return "base64", up + low + dig + "+/"
        if re.search("[_-]", run):
            return "base64url", up + low + dig + "-_"
        return "base62", up + low + dig
    if upper or lower:
        return ("base36", (up if upper else low) + dig) if digit else ("letters", up if upper else low)
    return None


def _gains(run: str, alphabet: str) -> list[float]:
    """What each character adds to the log-likelihood of "uniform over ``alphabet``" over that of text."""
    letters = sum(c.isalpha() for c in alphabet)
    cased = any(c.islower() for c in alphabet) and any(c.isupper() for c in alphabet)
    out, total = [], sum(_FREQUENT.values())
    others = len(alphabet) - letters
    for i, c in enumerate(run):
        if c.isalpha():
            q = _FREQUENT[c.lower()] / total
            if cased:  # text changes case at a word's start only
                q *= 0.5 if i == 0 else (0.9 if c.isupper() == run[i - 1].isupper() or not run[i - 1].isalpha() else 0.1)
            q *= 0.9 if others else 1.0
        else:  # in text digits follow digits
            q = (0.9 if i and not run[i - 1].isalpha() else 0.1) / max(others, 1)
        out.append(-math.log(len(alphabet)) - math.log(q))
    return out


def _binomial_tail(n: int, least: int, p: float) -> float:
    """The probability of at least ``least`` successes in ``n`` trials."""
    if least <= 0:
        return 1.0
    term = math.exp(math.lgamma(n + 1) - math.lgamma(least + 1) - math.lgamma(n - least + 1) + least * math.log(p) + (n - least) * math.log1p(-p))
    total, k = 0.0, least
    while k <= n and term > total * 1e-12:
        total += term
        term *= (n - k) / (k + 1) * p / (1 - p)
        k += 1
    return min(1.0, total)


def _class(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2


def evenness_p(run: str, alphabet: str) -> float | None:
    """Chi-squared: how probable letters as evenly spread as those of ``run``, or more so, are in text of its alphabet.

    The statistic counts pairs of equal letters, which chi-squared over single letters is but for constants; under text it
    is taken as gamma-distributed with its exact mean and variance.  Digits are as even in text, so they are left out.
    """
    counts = Counter(c for c in run if c.isalpha())
    n, mixed = sum(counts.values()), any(c.islower() for c in alphabet) and any(c.isupper() for c in alphabet)
    if n < LEAST_TESTED:
        return None
    q = [_FREQUENT[c.lower()] * ((0.15 if c.isupper() else 0.85) if mixed else 1.0) for c in alphabet if c.isalpha()]
    total = sum(q)
    two, three = sum((x / total) ** 2 for x in q), sum((x / total) ** 3 for x in q)
    mean = n * (n - 1) / 2 * two
    var = mean * (1 - two) + n * (n - 1) * (n - 2) * (three - two * two)
    found = sum(c * (c - 1) / 2 for c in counts.values()) + 0.5
    shape = mean * mean / var
    z = ((found / mean) ** (1 / 3) - (1 - 1 / (9 * shape))) * math.sqrt(9 * shape)
    return 0.5 * math.erfc(-z / math.sqrt(2))


def runs_p(run: str) -> float | None:
    """Runs: how probable as many changes between upper case, lower case and digits are in text."""
    pairs = [(_class(a), _class(b)) for a, b in zip(run, run[1:], strict=False) if a.isalnum() and b.isalnum()]
    kinds = {_class(c) for c in run if c.isalnum()}
    if len(kinds) < 2 or len(pairs) < LEAST_TESTED:
        return None
    return _binomial_tail(len(pairs), sum(a != b for a, b in pairs), TEXT_TURNS if {1, 2} <= kinds else TEXT_TURNS_ONE_CASE)


def serial_p(run: str) -> float | None:
    """Serial correlation: how probable so few turns from vowel to consonant and back are in text."""
    signs = [None if not c.isalpha() else c.lower() in "aeiouy" for c in run]
    pairs = [(a, b) for a, b in zip(signs, signs[1:], strict=False) if a is not None and b is not None]
    if len(pairs) < LEAST_TESTED:
        return None
    return _binomial_tail(len(pairs), sum(a == b for a, b in pairs), 1 - TEXT_ALTERNATES)


def text_p_value(run: str, alphabet: str) -> float:
    """The three tests' combined p-value of "``run`` is text": the sum of their normal scores."""
    ps = [x for x in (evenness_p(run, alphabet), runs_p(run), serial_p(run)) if x is not None]
    if not ps:
        return 1.0
    z = -sum(_NORMAL.inv_cdf(min(max(x, 1e-15), 1 - 1e-6)) for x in ps)
    return 0.5 * math.erfc(z / math.sqrt(2 * (len(ps) + TOGETHER * len(ps) * (len(ps) - 1))))


def random_like(run: str, alphabet: str, least: float = 1e-3) -> bool:
    """Whether none of the three tests contradicts independent uniform characters, at the level ``least`` each."""
    n, k = len(run), len(alphabet)
    at = [alphabet.index(c) for c in run]
    cells = min(k, max(2, n // 4))  # bins with four expected characters or so
    counts = Counter(a * cells // k for a in at)
    sizes = Counter(a * cells // k for a in range(k))
    chi = sum((counts[b] - n * sizes[b] / k) ** 2 / (n * sizes[b] / k) for b in range(cells))
    if _chi2_tail(chi, cells - 1) < least:
        return False
    if _chi2_tail(max(0.0, k / n * sum(c * c for c in Counter(at).values()) - n), k - 1) < least:
        return False  # the same over single characters
    high = [a >= k / 2 for a in at]
    n1, n0 = sum(high), n - sum(high)
    if not n1 or not n0:
        return False
    runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
    mean, var = 1 + 2 * n1 * n0 / n, 2 * n1 * n0 * (2 * n1 * n0 - n) / (n * n * (n - 1))
    if var <= 0 or _tail((runs - mean) / math.sqrt(var)) < least:
        return False
    m = sum(at) / n
    v = sum((a - m) ** 2 for a in at)
    r = sum((a - m) * (b - m) for a, b in zip(at, at[1:], strict=False)) / v if v else 1.0
    return _tail((r + 1 / n) * math.sqrt(n)) >= least


def _p_value(core: str) -> float:
    found = encoding(core)
    if found is None or any(c not in found[1] for c in core):
        return 1.0
    p = text_p_value(core, found[1])
    return p if p < 1 and random_like(core, found[1]) else 1.0


def _best_ranges(gains: list[float]) -> list[tuple[int, int]]:
    """All disjoint ranges of the largest sums (Ruzzo and Tompa)."""
    done: list[tuple] = []
    kept: list[tuple] = []  # (start, end, sum before, sum after)
    total = least = 0.0
    for i, g in enumerate(gains):
        before, total = total, total + g
        if g <= 0:
            if total <= least:  # nothing joins over a new least sum
                least, done, kept = total, done + kept, []
            continue
        new = (i, i + 1, before, total)
        while kept:
            j = next((j for j in reversed(range(len(kept))) if kept[j][2] < new[2]), None)
            if j is None or kept[j][3] >= new[3]:
                break
            new = (kept[j][0], i + 1, kept[j][2], total)
            del kept[j:]
        kept.append(new)
    return [(s, e) for s, e, _, _ in done + kept]


def _parts(run: str) -> list[tuple[float, int, int, int]]:
    """Disjoint parts of a run of several words that are unlike text, as (p-value, length, start, end).

    Parts are single words and grouped hex (3/2 n of n words at most), and ranges of words that base64 or its URL-safe
    form can hold (n (n - 1)); p-values are multiplied by twice the number of all parts of either kind.
    """
    words = [m.span() for m in _WORD.finditer(run)]
    if len(words) < 2:
        return []
    singles = {(s, e): run[s:e] for s, e in words} | {m.span(): m[0].replace("-", "") for m in _GROUPED.finditer(run)}
    ranges = {}
    for joints in _JOINTS:
        own: list[tuple[int, int]] = []
        for k, (s, e) in enumerate(words):
            own.append((s, e))
            if k + 1 < len(words) and all(c in joints for c in run[e : words[k + 1][0]]):
                continue
            start = own[0][0]
            if len(own) > 1 and e - start >= LEAST_RUN:
                gains = _gains(run[start:e], _ALNUM + joints)
                ends = [0, *(x - start for _, x in own)]
                best = _best_ranges([sum(gains[x:y]) for x, y in zip(ends, ends[1:], strict=False)])
                ranges |= {(own[i][0], own[j - 1][1]): run[own[i][0] : own[j - 1][1]] for i, j in best}
            own = []
    tries = ((singles, 3 * len(words)), (ranges, 2 * len(words) * (len(words) - 1)))
    found = sorted((_p_value(core) * n, s, e, len(core)) for spans, n in tries for (s, e), core in spans.items() if len(core) >= LEAST_RUN)
    taken = np.zeros(len(run), bool)
    out = []
    for p, s, e, n in found:
        if p < 1 and not taken[s:e].any():
            taken[s:e] = True
            out.append((p, n, s, e))
    return out


def _discovered(tested: list[tuple[float, int, int, int]], rate: float) -> set[tuple[int, int]]:
    """The Benjamini-Hochberg rule, weighted by length."""
    if not tested:
        return set()
    mean = sum(t[1] for t in tested) / len(tested)
    ranked = sorted((min(1.0, p * mean / n), s, e) for p, n, s, e in tested)
    keep = max((i for i, (p, _, _) in enumerate(ranked, 1) if p <= rate * i / len(ranked)), default=0)
    return {(s, e) for _, s, e in ranked[:keep]}


def _as_wholes(text: str, spans: list[tuple[int, int]]) -> list[tuple[float, int, int, int]]:
    tested = []
    for s, e in spans:
        run = text[s:e].strip("=_-+/")
        s += text[s:e].find(run) if run else 0
        if len(run) >= LEAST_RUN:
            core = run.replace("-", "") if _GROUPED.fullmatch(run) else run
            tested.append((_p_value(core), len(core), s, s + len(run)))
    return tested


def _random_spans(text: str, runs: list[tuple[int, int]], rate: float) -> list[tuple[str, int, int]]:
    tested = _as_wholes(text, runs)
    found = _discovered(tested, rate)
    # "=" is in no value but at its end
    for split in (lambda run: _as_wholes(run, [m.span() for m in re.finditer("[^=]+", run)]) if "=" in run else [], _parts):
        smaller = []
        for t in tested:
            at = t[2]
            inner = [] if t[2:] in found else split(text[at : t[3]])
            smaller += [(p, n, at + s, at + e) for p, n, s, e in inner] or [t]
        tested = smaller
        found |= _discovered(tested, rate)
    return [("random", s, e) for s, e in found]


def scan(text: str | None, rate: float = RATE) -> list[tuple[str, int, int]]:
    """All spans ``(kind, start, end)`` of one text, by start, then kind in the order of KINDS."""
    text = text or ""
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text) if m.end() - m.start() >= LEAST_HEX]
    out += _random_spans(text, [m.span() for m in _RUN.finditer(text) if m.end() - m.start() >= LEAST_RUN], rate)
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


_HEX_BYTES = np.zeros(256, bool)
_HEX_BYTES[[*b"0123456789abcdef"]] = True
_RUN_BYTES = np.zeros(256, bool)
_RUN_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_=-"]] = True


def _long_runs(inside: np.ndarray, least: int) -> np.ndarray:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    starts, ends = edge[::2], edge[1::2]
    return starts[ends - starts >= least]


def suspects(column: pa.Array) -> np.ndarray:
    """Rows where a scan could find something: a cheap pass over bytes that misses none."""
    buf, off = tk.flat(column)
    hit = np.zeros(len(off) - 1, bool)
    for a, b in tk.slices(off):
        text, own = buf[off[a] : off[b]], off[a : b + 1] - off[a]
        at = [_long_runs(_HEX_BYTES[text], LEAST_HEX), _long_runs(_RUN_BYTES[text], LEAST_RUN)]
        # a run may begin in an earlier row and reach over its end: both rows are suspects
        low = tk.LOWER[text].tobytes()
        for hint in _HINTS:
            found, p = [], low.find(hint)
            while p >= 0:
                found.append(p)
                p = low.find(hint, p + len(hint))
            at.append(np.array(found, np.int64))
        for x in at:
            hit[a + np.searchsorted(own, x, "right") - 1] = True
        ends = own[1:-1]
        ends = ends[(ends > 0) & (ends < len(text))]
        joined = ends[_RUN_BYTES[text[ends - 1]] & _RUN_BYTES[text[ends]]] if len(ends) else ends
        for x in (joined - 1, joined):
            hit[a + np.searchsorted(own, x, "right") - 1] = True
    return hit


def _scanned(column: pa.Array, rate: float) -> Iterator[list[tuple[str, int, int]]]:
    hit = suspects(column)
    for i in range(len(column)):
        yield scan(column[i].as_py(), rate) if hit[i] else []


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def secret_scans(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """A row for each row of ``docs(doc_id, text)``: counts by fixed pattern, their digest, and all spans.

    ``rate`` bounds the false discoveries among a document's tested runs, and anew among each cut of those not found.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, digests, spans = [], [], []
            for found in _scanned(b.column("text"), rate):
                base = [x for x in found if x[0] != "random"]
                counts.append([sum(x[0] == k for x in base) for k in KINDS[:3]])
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(found))
            n = np.array(counts, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(n[:, k]) for k in range(3)), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with each maximal run of spans replaced by ``mark``."""
    out, at = [], 0
    for _, s, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """``docs`` with secrets in ``text`` replaced, and ``n_chars`` (where present) as the new text has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column, names = b.column("text"), b.schema.names
            lengths = b.column("n_chars").to_pylist() if "n_chars" in names else None
            found = [(i, x) for i, x in enumerate(_scanned(column, rate)) if x]
            if found:
                texts = column.to_pylist()
                for i, spans in found:
                    texts[i] = redact(texts[i], spans)
                    if lengths:
                        lengths[i] = len(texts[i])
                at = names.index("text")
                b = b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))
                if lengths:
                    at = names.index("n_chars")
                    b = b.set_column(at, b.schema.field(at), pa.array(lengths, b.schema.field(at).type))
            yield b

    return docs.mapInArrow(run, docs.schema)


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def secret_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can express of the scan's rows: the counts by fixed pattern."""
    return op10_secret_scans(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


SECRET_COUNTS_SQL = r"""
select doc_id,
  len(list_filter(regexp_extract_all(coalesce(text, ''), '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2),
    lambda x: length(x) >= 12))::bigint as n_assign,
  len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 18))::bigint as n_access,
  len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 16))::bigint as n_hex
from documents
"""

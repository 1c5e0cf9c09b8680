"""Secrets in texts: fixed patterns, and a linear-chain conditional random field.

Every token of a text is tagged begin, inside or outside; the tokens of a line
are one chain, with outside before and after.  A token's features are its
shape, the words and marks before and after it, how far the next word that
announces a secret is on either side, and what kind of file the text seems to
be.  What depends on the token alone is worked out once for each distinct token
and remembered; scores are sums of looked-up weights for all tokens at once.

The labels are the likeliest by Viterbi.  A token whose score for outside is
greater than any neighbours could make up for is outside on the likeliest path,
whatever else is on it (``Field.margin``); chains are cut there, and only what
lies between is walked.  This changes no label.

The field is fitted by ``secret_lines`` on labelled lines made by rule; its
weights are kept in secret_field.json, which ``python -m
trackforge.llm.secret_lines`` writes.

Spans of the patterns always stay; a span of the field is added unless one of
them holds it.  Spans count code points, ends are exclusive.

Defined results: a null text is empty and has no spans; texts are read whole;
repeated rows stay; an empty table gives an empty result; columns named like
the results are replaced by them.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import accumulate
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from trackforge.llm.common import in_batches, span_hashes, utf8

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
#: Runs shorter than what is asked for are dropped, so they need not match.
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]{16,}"), re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the three fixed patterns, leftmost and not overlapping within each."""
    low = text.lower()
    found: list[Span] = []
    if "pass" in low or "secret" in low or "token" in low or "api" in low:
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


# ---- what is known of a token by itself

_HINT = re.compile(r"pass(?:word|wd|phrase|code|wort)|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|authori[sz]ation|bearer|contrase|mot-?de-?passe|kennwort", re.I)
_WEAK = re.compile(r"(?:^|[_-])(?:key|keys|login|auth|pin|pw|code|signature|salt|apikey|creds?|dsn|otp|seed)$", re.I)
_PREFIX = re.compile(r"(?:gh[pousr]_|github_pat_|glpat-|sk[-_]|pk[-_]|rk_|xox[abprs]-|AKIA|ASIA|AIza|ya29\.|eyJ|SG\.|npm_|hf_|dop_v1_|shpat_|MII|LS0t|AAAA)")
_PLACE = re.compile(r"https?|www\.|//|/[a-z]|[a-z0-9-]+\.(?:com|org|net|io|de|fr|es|html?|jpe?g|png|py|js|txt|csv|json|pdf)\b", re.I)
# Words that tell something about their neighbours; all others are one.
WORDS = {w: i + 1 for i, w in enumerate(
    "is was are be it the a an of to for as with use used using my your our this that here and or not no must set get new old reset value equals bearer basic password passwd passphrase "
    "passcode pwd pw secret token key api private access client auth authorization credential credentials login user username name id order number no. phone call tel isbn version page "
    "chapter commit revision checksum sha256 sha1 md5 uuid model serial tracking invoice account iban card date time build export var const let string code pin otp seed salt ssh rsa begin end http https file path "
    "est ist es la le der die das de für pour para con mit el y et und".split())}  # fmt: skip
_SIZES = (1, 3, 6, 8, 12, 16, 20, 24, 32, 40, 64)
_STRIP_LEFT, _STRIP_RIGHT = ".-!?*~%^&#", ".-?*~"
_ALNUM = re.compile(r"[^\W_]")
_REPEATED = re.compile(r"([-.!?*~%^&#$])\1+$")
_VOWELS = "aeiouyAEIOUYäöüéèêàáíóú"
_CONSONANTS = re.compile(r"[bcdfghjklmnpqrstvwxz]{5,}", re.I)
LOOKS = 18
HINT, WEAK, LOWER, TITLE, UPPER, SHORT_NUMBER, NUMBER, MIXED_SHORT, MIXED, MIXED_LONG, ODD_CASE, LONG_LOWER, PLACE, HEXLIKE, MARKED, PREFIXED, COMPOUND = range(1, LOOKS)


@dataclass(frozen=True, slots=True)
class Shape:
    lead: int  # bytes of punctuation before the token proper and after it
    trail: int
    look: int
    kinds: int
    size: int
    turns: int
    odd: int
    word: int
    marks: int


def shape(raw: str) -> Shape | None:
    """What a token looks like; null if it has neither letter nor digit."""
    t = raw.lstrip(_STRIP_LEFT)
    lead = len(raw) - len(t)
    t = _REPEATED.sub("", t).rstrip(_STRIP_RIGHT)
    if t.endswith("!") and not any(c.isdigit() for c in t):
        t = t.rstrip("!")
    if not _ALNUM.search(t):
        return None
    trail = len(raw) - lead - len(t)
    n = len(t)
    if t.isalpha() and (t.islower() or t.isupper() or t[0].isupper() and t[1:].islower()):  # a plain word: as below, but at once
        upper = n if t.isupper() else int(not t.islower())
        odd = 0
        if n > 7:
            vowels = sum(map(t.count, _VOWELS))
            odd = (vowels * 5 < n) + (vowels * 4 < n)
        odd += bool(_CONSONANTS.search(t))
        low = t.lower()
        if n < 40 and _HINT.search(t) or low in ("apikey", "passwort"):
            look = HINT
        elif n < 24 and _WEAK.search(low):
            look = WEAK
        elif n >= 16 and re.fullmatch("[a-f]+|[A-F]+", t):
            look = HEXLIKE
        elif low.startswith("http"):
            look = PLACE
        elif not upper:
            look = LONG_LOWER if n >= 14 else LOWER
        else:
            look = UPPER if upper == n else TITLE
        return Shape(len(raw[:lead].encode()), len(raw[len(raw) - trail :].encode()) if trail else 0, look, 2 * (upper > 0) + 4 * (upper < n), sum(n >= x for x in _SIZES), 0, odd, WORDS.get(low, 0), 0)
    digits = upper = lower = turns = vowels = special = 0
    before = ""
    for c in t:
        if c.isdigit():
            digits, kind = digits + 1, "d"
        elif c.isupper():
            upper, kind = upper + 1, "U"
        elif c.isalpha():
            lower, kind = lower + 1, "l"
        else:
            special += c in "&!#$%^*~?"
            kind = "s"
        vowels += c in _VOWELS
        turns += kind != before and before not in ("", "s") and kind != "s" and not (kind == "l" and before == "U")
        before = kind
    letters, other = upper + lower, n - digits - upper - lower
    size = sum(n >= x for x in _SIZES)
    parts = re.split(r"[._/+-]+", t)
    wordlike = all(not p or p.isalpha() and (p[1:].islower() or p.isupper() or len(p) < 2) or p.isdigit() and len(p) < 5 for p in parts)
    odd = (letters > 7 and vowels * 5 < letters) + (letters > 7 and vowels * 4 < letters) + bool(_CONSONANTS.search(t))
    if _HINT.search(t) and digits * 3 < n and n < 40 and wordlike or t.lower() in ("apikey", "passwort"):
        look = HINT
    elif _PREFIX.match(t) and n >= 12 and not wordlike:
        look = PREFIXED
    elif _WEAK.search(t) and n < 24 and digits < 2:
        look = WEAK
    elif not letters:
        look = NUMBER if digits > 4 else SHORT_NUMBER
    elif special and (digits or upper and lower):
        look = MARKED
    elif n >= 16 and re.fullmatch("[0-9a-f]+|[0-9A-F]+|[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", t):
        look = HEXLIKE
    elif _PLACE.match(t) and not (n > 30 and turns > n // 4):
        look = PLACE
    elif other and wordlike:
        look = COMPOUND
    elif digits:
        look = MIXED_LONG if n >= 16 else MIXED if n >= 8 else MIXED_SHORT
    elif turns > 2 or turns > 1 and n >= 16:
        look = ODD_CASE
    elif lower == letters:
        look = LONG_LOWER if n >= 14 else LOWER
    else:
        look = UPPER if upper == letters else TITLE
    kinds = (digits > 0) + 2 * (upper > 0) + 4 * (lower > 0) + 8 * (other > 0)
    marks = min(2, t.count(".")) + 3 * min(2, t.count("-")) + 9 * min(2, t.count("/"))
    return Shape(len(raw[:lead].encode()), len(raw[len(raw) - trail :].encode()) if trail else 0, look, kinds, size, min(7, turns), odd, WORDS.get(t.lower(), 0), marks)


class Shapes:
    """Shapes by token, remembered; beyond ``most`` tokens the memory starts anew."""

    def __init__(self, most: int = 250_000) -> None:
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.index: dict[int, int] = {}
        self.table = np.zeros((1 << 12, 9), np.int32)

    def rows(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A row (lead, trail, look, kinds, size, turns, odd, word, marks) for each token; look 0: no token."""
        kept, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.index) + len(kept) > self.most:
            self.clear()
        at = np.fromiter((self.index.get(h, -1) for h in kept.tolist()), np.int64, len(kept))
        new = np.flatnonzero(at < 0)
        n = len(self.index)
        while n + len(new) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for i, h, j in zip(new.tolist(), kept[new].tolist(), first[new].tolist()):
            found = shape(data[starts[j] : ends[j]].tobytes().decode("utf-8", "replace"))
            if found:
                self.table[n] = (found.lead, found.trail, found.look, found.kinds, found.size, found.turns, found.odd, found.word, found.marks)
            self.index[h] = at[i] = n
            n += 1
        return self.table[at[inverse]]


# ---- what is known of a token where it stands

_TOKEN = np.zeros(256, bool)
_TOKEN[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_+/.-&!#$%^*~?", *range(128, 256)]] = True
_SIDE = np.full(256, 14, np.int64)
for _i, _chars in enumerate((b"\n\r\x0b\x0c", b" \t", b"\"'`", b"=", b":", b"(", b"[{", b"<", b">", b"@", b",;", b")]}", b"|"), start=1):
    _SIDE[list(_chars)] = _i
SIDES, DISTANCES, N_WORDS = 15, 7, len(WORDS) + 1
#: Sizes of the weight tables, one for each column of ``features``.
TABLES = (LOOKS * DISTANCES * 4, LOOKS * 5, LOOKS * LOOKS, LOOKS * LOOKS, 16 * 12, 8 * 12, 16 * 4, N_WORDS, N_WORDS, N_WORDS, N_WORDS, SIDES * LOOKS, SIDES * LOOKS, 4 * LOOKS, 27 * LOOKS, 12 * LOOKS)


@dataclass(frozen=True)
class Tokens:
    starts: np.ndarray  # bytes
    ends: np.ndarray
    row: np.ndarray
    line: np.ndarray  # increasing over the rows
    codes: np.ndarray  # a column for each table


def features(data: np.ndarray, offsets: np.ndarray, shapes: Shapes) -> Tokens:
    """All tokens of the rows and their features, as places in one table of all weights."""
    token = np.concatenate([[False], _TOKEN[data], [False]])
    edge = token[1:] != token[:-1]
    cut = offsets[1:-1]
    inner = cut[token[cut] & token[cut + 1]] if len(data) else cut[:0]  # rows that meet without a gap
    starts, ends = np.union1d(np.flatnonzero(edge & token[1:]), inner), np.union1d(np.flatnonzero(edge & token[:-1]), inner)
    ends = ends - ((data[ends - 1] == 46) & (ends - starts > 1)) if len(ends) else ends  # a full stop is no part of a token; fewer tokens differ
    known = shapes.rows(data, starts, ends).astype(np.int64)
    real = known[:, 2] > 0
    known, starts, ends = known[real], starts[real] + known[real, 0], ends[real] - known[real, 1]
    n = len(starts)
    row = np.searchsorted(offsets, starts, "right") - 1
    breaks = np.cumsum(np.isin(data, [10, 13]))
    line = (breaks[starts] if n else starts) + row
    look, kinds, size, turns, odd, word, marks = known[:, 2:].T
    first = np.ones(n, bool)
    first[1:] = line[1:] != line[:-1]
    last = np.ones(n, bool)
    last[:-1] = first[1:]

    def beside(x: np.ndarray, by: int) -> np.ndarray:
        """x of the token ``by`` places before (negative) or after in the same line, else 0."""
        out = np.zeros_like(x)
        if by < 0 and n > -by:
            out[-by:] = np.where(line[-by:] == line[:by], x[:by], 0)
        elif by > 0 and n > by:
            out[:-by] = np.where(line[by:] == line[:-by], x[by:], 0)
        return out

    place = np.arange(n)
    hint = look == HINT
    announced = np.maximum.accumulate(np.where(hint, place, -1)) if n else place
    before = np.concatenate([[-1], announced[:-1]])
    gap = np.where((before >= 0) & (line[before] == line), place - before, 0) if n else place
    distance = np.select([gap == 0, gap < 4, gap < 7, gap < 13], [0, gap, 4, 5], 6)
    weak = look == WEAK
    distance = np.where((distance == 0) & beside(weak.astype(np.int64), -1).astype(bool), 6, distance)
    ahead = np.select([beside(hint.astype(np.int64), k) > 0 for k in (1, 2, 3)], [1, 2, 3], np.where(beside(weak.astype(np.int64), 1) > 0, 4, 0))
    previous_end = np.where(first, np.maximum(offsets[row], starts - 4), np.concatenate([[0], ends[:-1]])[:n])
    equals, colon, blank = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool)
    for k in range(1, 5):
        at = starts - k
        inside = at >= previous_end
        byte = np.where(inside, data[np.maximum(at, 0)] if n else at, 0)
        equals |= byte == 61
        colon |= byte == 58
        blank |= inside & (byte <= 32)
    glued = ~first & ~blank & (starts - previous_end <= 4)
    mark = np.select([equals, colon, glued], [1, 2, 3], 0)
    left = np.where(starts > offsets[row], _SIDE[data[np.maximum(starts - 1, 0)]] if n else starts, 0)
    right = np.where(ends < offsets[row + 1], _SIDE[data[np.minimum(ends, len(data) - 1)]] if n else ends, 0)
    signs = np.concatenate([[0], np.cumsum(np.isin(data, list(b"={};<>")))])
    length = np.diff(offsets)
    file = (np.diff(signs[offsets]) * 60 > length) + 2 * (length < 400)
    columns = (
        (look * DISTANCES + distance) * 4 + mark, look * 5 + ahead, beside(look, -1) * LOOKS + look, look * LOOKS + beside(look, 1), kinds * 12 + size, turns * 12 + size, kinds * 4 + odd, word, beside(word, -1),
        beside(word, 1), beside(word, -2), left * LOOKS + look, right * LOOKS + look, file[row] * LOOKS + look, marks * LOOKS + look, size * LOOKS + look,
    )
    codes = np.stack([c + base for c, base in zip(columns, np.concatenate([[0], np.cumsum(TABLES)[:-1]]))], 1).astype(np.int32)
    return Tokens(starts, ends, row, line, codes)


OUTSIDE, BEGIN, INSIDE = range(3)


@dataclass(frozen=True)
class Field:
    """A linear-chain conditional random field over outside, begin, inside."""

    weights: np.ndarray  # (sum of TABLES, 3)
    moves: np.ndarray

    def margin(self) -> np.ndarray:
        """By how much begin and inside can gain from their neighbours over outside, at most."""
        m = self.moves
        return np.array([(m[:, None, x] + m[None, x, :] - m[:, None, OUTSIDE] - m[None, OUTSIDE, :]).max() for x in (BEGIN, INSIDE)])

    def scores(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(codes), 3))
        for column in codes.T:
            out += self.weights[column]
        return out

    def decode(self, scores: np.ndarray) -> list[int]:
        """The likeliest labels of a chain by Viterbi, with outside before and after."""
        best, back = self.moves[OUTSIDE] + scores[0], []
        for row in scores[1:]:
            through = best[:, None] + self.moves
            back.append(through.argmax(axis=0))
            best = through.max(axis=0) + row
        labels = [int((best + self.moves[:, OUTSIDE]).argmax())]
        for b in reversed(back):
            labels.append(int(b[labels[-1]]))
        return labels[::-1]

    def labels(self, tokens: Tokens) -> np.ndarray:
        """The likeliest label of every token, its line being the chain."""
        scores = self.scores(tokens.codes)
        out = np.zeros(len(scores), np.int64)
        undecided = np.flatnonzero((scores[:, OUTSIDE, None] - scores[:, 1:] <= self.margin()).any(axis=1))
        if len(undecided):
            apart = (np.diff(undecided) > 1) | (np.diff(tokens.line[undecided]) > 0)
            for run in np.split(undecided, np.flatnonzero(apart) + 1):
                out[run] = self.decode(scores[run])
        return out

    def spans(self, texts: pa.Array, shapes: Shapes, size: int = 1 << 18) -> list[list[Span]]:
        """Spans of each text; texts are read in parts of about ``size`` bytes, each whole."""
        every, offsets = utf8(texts)
        out: list[list[Span]] = [[] for _ in range(len(texts))]
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
            data, part = every[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
            tokens = features(data, part, shapes)
            labels = self.labels(tokens)
            secret, last = np.flatnonzero(labels).tolist(), -2
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)]) if secret else part
            for i in secret:
                start, stop, row = int(tokens.starts[i]), int(tokens.ends[i]), int(tokens.row[i])
                limit, base = int(part[row + 1]), int(points[part[row]])
                for _ in range(2):  # padding of base 64
                    stop += stop < limit and data[stop] == 61 and (stop + 1 == limit or not _TOKEN[data[stop + 1]])
                first, after = int(points[start]) - base, int(points[stop]) - base
                if i == last + 1 and labels[i] == INSIDE and tokens.line[i] == tokens.line[last]:
                    out[at + row][-1] = ("crf", out[at + row][-1][1], after)
                else:
                    out[at + row].append(("crf", first, after))
                last = i
            at = end
        return out


_FILE = Path(__file__).with_name("secret_field.json")


def stored(path: Path = _FILE) -> Field:
    """The field of a file: rows of [place, outside, begin, inside], all others being zero, and the moves."""
    kept = json.loads(path.read_text())
    weights = np.zeros((sum(TABLES), 3))
    rows = np.array(kept["weights"])
    weights[rows[:, 0].astype(int)] = rows[:, 1:]
    return Field(weights, np.array(kept["moves"]))


@cache
def trained() -> Field:
    return stored()


@cache
def _shared_shapes() -> Shapes:
    """One memory for all tasks of a Python worker."""
    return Shapes()


def find(texts: pa.Array, field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base spans, and all spans, of each text."""
    out = []
    for text, own in zip(texts.to_pylist(), field.spans(texts, _shared_shapes())):
        base = base_spans(text or "")
        starts, reach = [b[1] for b in base], list(accumulate((b[2] for b in base), max))
        extra = [s for s in own if not (i := bisect_right(starts, s[1])) or reach[i - 1] < s[2]]
        out.append((base, sorted(base + extra, key=_order)))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _apply(documents: DataFrame, fields: list[tuple[str, pa.DataType, T.DataType]], made, field: Field | None) -> DataFrame:
    """Every row with ``fields`` in place of columns of these names; ``made`` gives them for a list of texts."""
    model = field or trained()
    names = [f[0] for f in fields]
    kept = [c for c in documents.columns if c.lower() not in names or c == "text"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = dict(zip(b.schema.names, b.columns))
            new = made(columns["text"], model)
            columns |= {name: pa.array(values, kind) for (name, kind, _), values in zip(fields, new)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    source = documents.select(*(F.col(quoted(c)) for c in kept))
    schema = T.StructType(list(source.schema.fields) + [T.StructField(name, kind) for name, _, kind in fields if name not in source.columns])
    return in_batches(source).mapInArrow(work, schema)


def scan(documents: DataFrame, field: Field | None = None) -> DataFrame:
    """Each row with n_assign, n_access, n_hex, base_sha256 and spans; no shuffle."""

    def made(texts: pa.Array, model: Field) -> list[list]:
        found = find(texts, model)
        counts = [[sum(s[0] == kind for s in base) for base, _ in found] for kind in KINDS[:3]]
        return [*counts, [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], [joined(spans) for _, spans in found]]

    long, text = (pa.int64(), T.LongType()), (pa.string(), T.StringType())
    return _apply(documents, [("n_assign", *long), ("n_access", *long), ("n_hex", *long), ("base_sha256", *text), ("spans", *text)], made, field)


def redact(documents: DataFrame, mask: str = "[secret]", field: Field | None = None) -> DataFrame:
    """The documents with ``mask`` in place of every secret, and n_chars as it is then (null texts stay null)."""

    def hidden(text: str, spans: list[Span]) -> str:
        out, at = [], 0
        for _, start, end in spans:
            if end <= at:
                continue
            if start >= at:
                out += [text[at:start], mask]
            at = end
        return "".join(out) + text[at:]

    def made(texts: pa.Array, model: Field) -> list[list]:
        done = [hidden(t, spans) for t, (_, spans) in zip(texts.to_pylist(), find(texts, model))]
        return [done, [len(t) for t in done]]

    absent = documents.filter("text IS NULL")
    done = _apply(documents.filter("text IS NOT NULL"), [("text", pa.string(), T.StringType()), ("n_chars", pa.int64(), T.LongType())], made, field)
    return done.select(*documents.columns, *([] if "n_chars" in documents.columns else ["n_chars"])).unionByName(absent, allowMissingColumns=True)

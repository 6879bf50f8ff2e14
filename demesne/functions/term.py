"""Lease terms in free text to start, expiry and tenure.

A term is read in three steps. The lexer turns the repaired text into tokens: dates, feast days with their
year, tenures, adjustments in days or months, the words that open or close a span, and what stands for
the date of the lease. Each token has one letter, so a term has a shape such as `TFD` ("99 years from
25 March 1868"). The rules are patterns over shapes; which rules a shape fits, and which tokens are its
dates and numbers, is worked out once per shape and kept, and there are few shapes. Last, the rules that fit
are tried in order on the values of the tokens, and the first that yields complete dates wins; a rule whose
date or number is impossible does not stop the search. If nothing is found, the term is read once more
without what stands in brackets.

Reading is Python over Arrow batches: a term costs some microseconds, about half a hundred expressions
in the plan would cost more. Rows pass through with all their columns, without a shuffle; equal terms of
a batch are read once. No filter on the result is pushed below the reading, so it is never done twice.

An expiry beyond the year 9999 ends the search with status 'overflow'. NULL and blank terms give NULL.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------- repairs

#: Ordered (pattern, replacement, ignore case) of the normaliser (fixed values).
REPAIRS: list[tuple[str, str, bool]] = [
    (r"^(?:For\s+)?(?:the\s+)?Residue\s+of\s+(?:the\s+)?(?:term\s+of\s+)?", "", True),
    (r" midnight on", "", False),
    (r" midnight", "", False),
    (r"and and", "and", False),
    (r"Nine hundred and ninety nine", "999", False),
    (r"Two hundred and fifty", "250", False),
    (r"[¼½¾]", "", False),
    (r"\b(\d{1,2})(?:st|nd|rd|th)\b", r"\1", True),
    (r"\b(\d{1,2})\s+of\s+([A-Za-z]+)\b", r"\1 \2", True),
    (r"\bincluding\s+on\b", "including", True),
    (r"\bto\s+and\s+expiring\b", "expiring", True),
    (r"\ban\s+including\b", "and including", True),
    (r"\bbeginning\s+in\b", "beginning on", True),
    (r"\bCommences\b", "commencing", True),
    (r"\bexpires\b", "expiring", True),
    (r"\bFrom\s*:", "From", True),
    (r"\bTo\s*:", "to", True),
    (r"\b(\d{1,2}):(\d{1,2}):(\d{4})\b", r"\1.\2.\3", False),
    (r"\bles\b", "less", True),
    (r"\brom\b", "from", True),
    (r"\bfrm\b", "from", True),
    (r"\bform\b", "from", True),
    (r"\bJanuaryu\b", "January", True),
    (r"\bJnuary\b", "January", True),
    (r"\bFeburary\b", "February", True),
    (r"\bFebuary\b", "February", True),
    (r"\bSeptmber\b", "September", True),
    (r"\bNovmber\b", "November", True),
    (r"\bDecmber\b", "December", True),
    (r"\band\s+to\s+and\s+including\b", "to and including", True),
    (r"\band\s+including\s+to\s+and\s+including\b", "to and including", True),
    (r"\btherein\s+mentioned\b", "the lease", True),
    (r"\bas\s+the\s+lease\b", "of the lease", True),
    (r"\bfrom(\d)", r"from \1", True),
    (r"\)for\b", ") from", True),
    (r"\bdate\s+hereof\b", "date of the lease", True),
    (r"\bincluding/from\b", "including", True),
    (r"\b31\s+(June|April|September|November)\b", r"30 \1", True),
    (r"\b31[/.](?=4|6|9|11)", "30/", False),
    (r"\s+hereof\s*$", "", True),
    (r"\s+thereof\s*$", "", True),
]


def _literal(pattern: str) -> str:
    """A lower-case text that must stand in whatever the pattern matches; empty if none is plain to see."""
    plain = re.sub(r"\(\?[:=]?[^()]*\)\??|\([^()]*\|[^()]*\)|\[[^]]*\]|\{[^}]*\}|\\.", "\n", pattern)
    return max(re.findall(r"[a-z0-9 ]+", re.sub(r".[?*+]", "\n", plain).lower()), key=len, default="")


_COMPILED = [(re.compile(p, re.I if loose else 0), r, _literal(p)) for p, r, loose in REPAIRS]
_SPACES = re.compile(r"[\s\u00a0\u2000-\u200a\u202f\u3000]+")
_DROPPED = dict.fromkeys(map(ord, "´~¨,?"))
_PAIRS = re.compile(r"\s*\([^)]*\)")


def repaired(term: str) -> str:
    t = _SPACES.sub(" ", term).strip(" ").translate(_DROPPED)
    low = t.lower()
    for pattern, replacement, literal in _COMPILED:
        if literal in low:
            new = pattern.sub(replacement, t)
            if new != t:
                t, low = new, new.lower()
    return t.strip(" ")


# ---------------------------------------------------------------- tokens

#: Number words that a term may use (fixed values).
NUMBER_WORDS = {
    "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10,
    "eleven": 11, "twelve": 12, "thirteen": 13, "fourteen": 14, "fifteen": 15, "sixteen": 16, "seventeen": 17, "eighteen": 18, "nineteen": 19,
    "twenty": 20, "thirty": 30, "forty": 40, "fifty": 50, "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90, "hundred": 100,
}
#: Quarter and feast days by name: day and month (fixed values).
FEASTS = {"christmas": (25, 12), "midsummer": (24, 6), "lady": (25, 3), "michaelmas": (29, 9)}

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_MONTH_OF = {name: k for k, m in enumerate(MONTHS, 1) for name in (m, m[:3])}

_NUMBER = rf"(?:(?<!\d)\d{{1,6}}|\b(?:{'|'.join(NUMBER_WORDS)}))"
_MONTH = rf"(?:{'|'.join(sorted(_MONTH_OF, key=len, reverse=True))})"
_GAP = r"[./ ]+"

#: Tokens with a value, in the order in which they are looked for.
_VALUED = {
    "D": rf"(?<!\d)\d{{1,2}}{_GAP}(?:{_MONTH}|\d{{1,2}}){_GAP}\d{{4}}",  # a date
    "H": rf"(?<!\d)\d{{1,2}} day of {_MONTH} \d{{4}}",  # a date, spelt out
    "S": rf"\b(?:{'|'.join(FEASTS)})(?: day)? \d{{4}}",  # a feast day
    "Q": r"(?<!\d)\d{1,4} (?:\d+/\d+|and (?:a )?(?:half|quarter)) ?years?\b",  # years and a fraction
    "U": rf"{_NUMBER} ?(?:years?(?:\b|(?=less))|days?\b|months?\b)",  # a number with its unit: T years, d or f (in words) days, m months
    "J": rf"\b{_MONTH} \d{{4}}(?= |$)",  # a month
    "g": rf"(?<!\d)\d{{1,2}} {_MONTH}(?= to\b)",  # a day whose year is missing
}
#: Phrases without a value: the words, and the letter they have in a shape.
_PHRASES = [
    ("on and from", "n"), ("and including", "j"), ("including", "i"), ("inclusive", "k"),
    ("from on", "w"), ("from from", "v"), ("from", "F"),
    ("commencing from", "c"), ("beginning from", "c"), ("starting from", "c"),
    ("commencing on", "C"), ("starting on", "C"), ("commencing", "C"), ("starting", "C"), ("beginning on", "b"), ("beginning", "B"),
    ("up to", "u"), ("terminating", "u"), ("until", "U"), ("to", "O"), ("expiring", "x"), ("ending", "e"),
    ("date of this the lease", "L"), ("date of this lease", "L"), ("date of the lease", "L"), ("date of lease", "L"),
    ("date this the lease", "K"), ("date this lease", "K"), ("date the lease", "K"), ("date lease", "K"),
    ("expiration of", "G"), ("thereafter", "R"), ("expiry", "X"),
    ("a term of", "A"), ("a term", "A"), ("term of", "E"), ("term", "E"), ("number of", "I"), ("number", "I"),
    ("for", "r"), ("less", "l"), ("last", "s"), ("plus", "p"), ("and", "a"), ("the", "t"), ("on", "o"), ("a", "z"), ("years", "y"), ("year", "y"),
]
_LETTER = dict(_PHRASES)
_TOKEN = re.compile("|".join([*(f"(?P<{k}>{v})" for k, v in _VALUED.items()), rf"(?:\b|(?<=years)(?=less)|(?<=year)(?=less))(?P<phrase>{'|'.join(p for p, _ in _PHRASES)})\b", r"(?P<number>\d+)", r"(?P<other>[a-z]+|[^ ])"]))


_ZEROS = {ord(str(k)): "0" for k in range(10)}


@lru_cache(100_000)
def _lexed(skeleton: str) -> tuple[str, tuple[tuple[int, int], ...]]:
    """(shape, place of each token) of a text whose digits are all 0: which digits they are makes no difference."""
    shape, places, end = [], [], -1
    for m in _TOKEN.finditer(skeleton):
        kind, word = m.lastgroup, m.group()
        if m.start() == end and word[0].isdigit() != skeleton[end - 1].isdigit() and word[0].isalnum() and skeleton[end - 1].isalnum():
            shape.append("_")
            places.append((end, end))
        end = m.end()
        if kind == "phrase":
            kind = _LETTER[word]
        elif kind == "U":
            kind = "T" if "year" in word else "m" if "month" in word else "d" if word[0] == "0" else "f"
        elif kind == "number":
            kind = "N" if len(word) <= 4 else "M" if len(word) <= 6 else "#"
        elif kind == "other":
            kind = word if word in "()" else "#"
        shape.append(kind)
        places.append(m.span())
    return "".join(shape), tuple(places)


def tokens(text: str) -> tuple[str, str, tuple[tuple[int, int], ...]]:
    """(shape, text in lower case, place of each token). What is no token has the letter #; _ says that a digit and a letter touch."""
    low = text.lower()
    shape, places = _lexed(low.translate(_ZEROS))
    return shape, low, places


# ---------------------------------------------------------------- rules

_OPEN = "(?:[FwvCBbc][ij]?_?|n)"
_FROM = "[Fcvn][ij]?"
_CLOSE = "_?a?[OxeUu]_?o?[ij]?t?"
_BARE = "^r?(?:A|E|z?I)y?[xe]o?[ij]?"


class Rule(NamedTuple):
    """`shape` names its tokens: a start, b end, y tenure, l and p days less and plus, q months less, m months.

    how: stated (all given), span (tenure from the dates), add (start and tenure), back (end and tenure),
    after (the tenure runs from the second date). A rule by the date of the lease has `dol`. By the day
    convention, the last day of a term that is added up is the one before the anniversary, but for `exclusive`.
    """

    name: str
    shape: str
    how: str
    dol: bool = False
    exclusive: bool = False


#: In order of precedence.
RULES = [
    Rule("1", f"(?P<y>[TQ]){_OPEN}t?(?P<a>D)k?{_CLOSE}(?P<b>D)", "stated"),
    Rule("2a", f"{_OPEN}t?(?P<a>D){_CLOSE}(?P<b>D)", "span"),
    Rule("2b", "^(?P<a>D)_?(?:[OU]_?|xo?[ij]?)(?P<b>D)", "span"),
    Rule("2c", "[xe]o?[ij]?(?P<b>D)F[ij]?(?P<a>D)", "span"),
    Rule("2d", f"{_FROM}(?P<a>D)(?:r[AE])?yxo?[ij]?(?P<b>D)", "span"),
    Rule("2e", f"{_FROM}(?P<a>D)axotG(?P<y>T)F(?P<b>D)", "after"),
    Rule("3a", rf"^A?(?P<y>[TQ])(?:\(?lt?s?(?P<l>[df])\)?|[pa](?P<p>[df])|l(?P<q>m))?{_OPEN}t?(?P<a>[DS])", "add", exclusive=True),
    Rule("3b", f"{_FROM}(?P<a>D)rt?E(?P<y>T)(?:lt?s?(?P<l>[df]))?", "add", exclusive=True),
    Rule("3c", f"^A?(?P<y>T)a?(?P<m>m){_OPEN}t?(?P<a>D)", "add", exclusive=True),
    Rule("4a", f"^(?:F[ij]?)?A?(?P<y>T){_OPEN}t?(?P<a>[DS])", "add"),
    Rule("4b", "[CBb][ij]?(?P<a>D)(?:r[AE])?(?P<y>T)", "add"),
    Rule("4c", f"{_FROM}(?P<a>D)rA?(?P<y>T)", "add"),
    Rule("4d", "^A?(?P<y>T)[xO]o?[ij]?(?P<b>D)", "back"),
    Rule("4e", f"{_OPEN}t?(?P<a>D)a[xX](?P<y>T)R", "add"),
    Rule("4f", "^A?(?P<y>T)[FwvCBbc]j?(?P<a>J)", "add"),
    Rule("5a", "^A?(?P<y>T)(?P<a>D)", "add"),
    Rule("5b", "^(?P<y>N)Ft?[ij]?(?P<a>D)", "add"),
    Rule("5c", f"^(?P<y>[NM])(?:l(?P<l>[df])|a(?P<p>[df])){_OPEN}t?(?P<a>D)", "add", exclusive=True),
    Rule("6a", "^A?(?P<y>T)[FwCBb]t?[LK]", "add", dol=True),
    Rule("6b1", f"{_BARE}t?(?P<b>H)", "span", dol=True),
    Rule("6b2", f"{_BARE}(?P<b>D)", "span", dol=True),
    Rule("6c", "^[xe]o?[ij]?(?P<b>D)$", "span", dol=True),
    Rule("6d", r"^A?(?P<y>T)(?:\(?l[df]\)?)?$", "add", dol=True),
    Rule("6d2", r"^(?P<y>N)\(ld\)$", "add", dol=True),
    Rule("6e", "^A?(?P<y>T)[FwvCBbc]j?$", "add", dol=True),
    Rule("6f", f"b[ij]?t?L{_CLOSE}(?P<b>D)", "span", dol=True),
    Rule("6f2", f"{_FROM}t?[LK]{_CLOSE}(?P<b>D)", "span", dol=True),
    Rule("6g", f"{_FROM}(?P<a>g)O[ij]?(?P<b>D)", "span", dol=True),
    Rule("6h", "^(?P<b>D)$", "span", dol=True),
]
_SHAPES = [re.compile(r.shape) for r in RULES]


@lru_cache(100_000)
def fitting(shape: str) -> tuple[tuple[Rule, dict[str, int]], ...]:
    """The rules that fit a shape, in order, each with the places of its tokens."""
    out = []
    for rule, pattern in zip(RULES, _SHAPES, strict=True):
        if m := pattern.search(shape):
            out.append((rule, {k: m.start(k) for k, v in m.groupdict().items() if v is not None}))
    return tuple(out)


# ---------------------------------------------------------------- dates and numbers

Day = tuple[int, int, int]  # year, month, day
_LENGTHS = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)


def _length(y: int, m: int) -> int:
    return 29 if m == 2 and y % 4 == 0 and (y % 100 != 0 or y % 400 == 0) else _LENGTHS[m - 1]


def day(y: int, m: int, d: int) -> Day | None:
    return (y, m, d) if y >= 1 and 1 <= m <= 12 and 1 <= d <= _length(y, m) else None


def number_of(x: Day) -> int:
    """Days since 1970-01-01, for any year."""
    y, m, d = x
    y -= m <= 2
    era, m = y // 400, m + (9 if m <= 2 else -3)
    in_era = y - era * 400
    return era * 146_097 + in_era * 365 + in_era // 4 - in_era // 100 + (153 * m + 2) // 5 + d - 719_469


def day_of(n: int) -> Day:
    n += 719_468
    era, n = divmod(n, 146_097)
    y = (n - n // 1460 + n // 36_524 - n // 146_096) // 365
    n -= 365 * y + y // 4 - y // 100
    k = (5 * n + 2) // 153
    m = k + (3 if k < 10 else -9)
    return y + era * 400 + (m <= 2), m, n - (153 * k + 2) // 5 + 1


def add_months(x: Day, months: int) -> Day:
    y, m = divmod(x[0] * 12 + x[1] - 1 + months, 12)
    return y, m + 1, min(x[2], _length(y, m + 1))


def whole_number(text: str) -> int | None:
    """Any digits in the text, run together; else a number word."""
    digits = re.sub(r"\D", "", text)
    if digits:
        n = int(digits)
        return n if n < 1 << 31 else None
    word = re.match(r"[a-z]*", text)
    return NUMBER_WORDS.get(word.group())


def years_of(text: str) -> float | None:
    """The years of a tenure: n a/b, n and a half or quarter, else a whole number."""
    head = text[: text.rindex("year")].strip()
    if head.isdigit():
        return float(head)
    n = re.match(r"(\d+) (?:(\d+)/(\d+)|and (?:a )?(half|quarter))$", head)
    if n and n.group(4):
        return int(n.group(1)) + (0.5 if n.group(4) == "half" else 0.25)
    if n and int(n.group(3)):
        return int(n.group(1)) + int(n.group(2)) / int(n.group(3))
    whole = whole_number(head)
    return None if whole is None else float(whole)


_SPLIT = re.compile(r"[./ ]+")


def date_of(kind: str, text: str, dol: Day | None) -> Day | None:
    """The day of a token: D and H in full, S a feast, J the first of a month, g in the year of the date of the lease."""
    p = _SPLIT.split(text)
    if kind == "D":
        return day(int(p[2]), int(p[1]) if p[1].isdigit() else _MONTH_OF[p[1]], int(p[0]))
    if kind == "S":
        d, m = FEASTS[p[0]]
        return day(int(p[-1]), m, d)
    if kind == "J":
        return day(int(p[1]), _MONTH_OF[p[0]], 1)
    if kind == "H":
        return day(int(p[4]), _MONTH_OF[p[3]], int(p[0]))
    return day(dol[0], _MONTH_OF[p[1]], int(p[0])) if dol else None


_DOL = re.compile(r"(\d{1,2})([-/.])(\d{1,2})\2(\d{4})")


def read_dol(dol: str | None) -> Day | None:
    """Date of the lease: d-m-y with dash, slash or full stop."""
    m = _DOL.fullmatch(dol.strip(" ")) if dol else None
    return day(int(m.group(4)), int(m.group(3)), int(m.group(1))) if m else None


def whole_years(start: Day, expiry: Day) -> int:
    """Years from start to expiry, rounded up from eleven months and a day, or if 30 days more complete a year."""

    def months(until: Day) -> int:
        k = (until[0] - start[0]) * 12 + until[1] - start[1]
        if until >= start:
            return k - (until < add_months(start, k))
        return k + (until > add_months(start, k))

    k = months(expiry)
    up = int(k / 12)
    if abs(k) % 12 == 11 and k > 0 and number_of(expiry) - number_of(add_months(start, k)) >= 1:
        up += 1
    return max(up, int(months(day_of(number_of(expiry) + 30)) / 12))


# ---------------------------------------------------------------- reading


class Parsed(NamedTuple):
    start: int | None  # days since 1970
    expiry: int | None
    tenure: float | None
    pattern: str
    status: str


def _apply(rule: Rule, at: dict[str, int], shape: str, low: str, places: tuple[tuple[int, int], ...], dol: Day | None, default_day: int) -> Parsed | None:
    def part(k: str) -> str:
        begin, end = places[at[k]]
        return low[begin:end]

    def date(k: str) -> Day | None:
        return date_of(shape[at[k]], part(k), dol) if k in at else None

    def number(k: str) -> int | None:
        return whole_number(part(k)) if k in at else 0

    a = dol if rule.dol and "a" not in at else date("a")
    if a is None and rule.how != "back":
        return None
    b, tenure = date("b"), None
    if "y" in at:
        text, kind = part("y"), shape[at["y"]]
        if kind == "Q" and rule.how == "stated":  # this rule may begin anywhere, and sees the number next to the word alone
            text = text[text.find("/") + 1 :] if "/" in text else "years"
        tenure = years_of(text) if kind in "TQ" else float(text)
        if tenure is None or tenure <= 0:
            return None
    if rule.how in ("add", "after", "back"):
        if rule.how != "add" and b is None:
            return None
        whole = int(tenure)
        less, plus, less_months, months = number("l"), number("p"), number("q"), number("m")
        if months is None:
            return None
        step = min(whole * 12 + round((tenure - whole) * 12) + months, 240_000)
        if rule.how == "back":
            a = add_months(b, -step)
        else:
            moved = number_of(add_months(a if rule.how == "add" else b, step))
            moved += (plus or 0) - ((less or 0) if rule.exclusive else default_day)
            b = add_months(day_of(moved), -(less_months or 0))
    if b is None:
        return None
    if b[0] > 9999 or a[0] < 1:
        return Parsed(None, None, None, rule.name, "overflow")
    if rule.how == "span":
        tenure = float(whole_years(a, b))
    return Parsed(number_of(a), number_of(b), tenure, rule.name, "parsed")


def _read(text: str, dol: Day | None, default_day: int) -> Parsed | None:
    shape, low, places = tokens(text)
    for rule, at in fitting(shape):
        if (not rule.dol or dol) and (found := _apply(rule, at, shape, low, places, dol, default_day)):
            return found
    return None


def read_term(term: str | None, dol: str | None = None, default_day: int = 1) -> Parsed | None:
    """One term; None if it says nothing."""
    text = repaired(term) if term else ""
    if not text:
        return None
    when = read_dol(dol)
    found = _read(text, when, default_day)
    if found is None and "(" in text:
        bare = _PAIRS.sub("", text).strip(" ")
        if bare and bare != text and (bare := repaired(bare)):
            found = _read(bare, when, default_day)
    return found


PARSED = T.StructType([T.StructField("start", T.DateType()), T.StructField("expiry", T.DateType()), T.StructField("tenure", T.DoubleType()), T.StructField("pattern", T.StringType()), T.StructField("status", T.StringType())])


def _as_struct(found: list[Parsed | None]) -> pa.StructArray:
    column = lambda k, kind: pa.array([x and x[k] for x in found], kind)
    fields = [column(0, pa.int32()).cast(pa.date32()), column(1, pa.int32()).cast(pa.date32()), column(2, pa.float64()), column(3, pa.string()), column(4, pa.string())]
    return pa.StructArray.from_arrays(fields, [f.name for f in PARSED], mask=pa.array([x is None for x in found]))


def with_parsed_term(df: DataFrame, term: str = "term", dol: str = "dol", out: str = "parsed", day_convention: str = "as_coded") -> DataFrame:
    """df with `out`: struct<start, expiry, tenure, pattern, status>, NULL where the term says nothing.

    day_convention 'exclusive' removes no default day from computed expiries. Every column of df passes through
    the reading, so select first what is needed.
    """
    default_day = {"as_coded": 1, "exclusive": 0}[day_convention]
    keep = [c for c in df.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known: dict[tuple, Parsed | None] = {}
            found = []
            for key in zip(b.column(term_at).to_pylist(), b.column(dol_at).to_pylist(), strict=True):
                if key not in known:
                    known[key] = read_term(*key, default_day)
                found.append(known[key])
            yield pa.RecordBatch.from_arrays([*b.columns, _as_struct(found)], names=[*b.schema.names, out])

    given = df.select(*keep)
    term_at, dol_at = keep.index(term), keep.index(dol)
    schema = T.StructType([*given.schema.fields, T.StructField(out, PARSED)])
    return given.mapInArrow(run, schema)


# ---------------------------------------------------------------- as expressions


def feast_date(name: Column, year: Column) -> Column:
    low = F.lower(name)
    out = F.lit(None).cast("date")
    for feast, (d, m) in FEASTS.items():
        out = F.when(low.startswith(feast), F.try_to_date(F.concat(year, F.lit(f"-{m:02d}-{d:02d}")), "yyyy-MM-dd")).otherwise(out)
    return out


def tenure_between(start: Column, expiry: Column) -> Column:
    """Whole years from start to expiry, rounded up from eleven months and a day, or if 30 days more complete a year."""

    def months(until: Column) -> Column:
        diff = (F.year(until) - F.year(start)) * 12 + F.month(until) - F.month(start)
        forward = diff - F.when(until < F.add_months(start, diff), 1).otherwise(0)
        backward = diff + F.when(until > F.add_months(start, diff), 1).otherwise(0)
        return F.when(until >= start, forward).otherwise(backward)

    def years(k: Column) -> Column:
        return F.when(k >= 0, F.floor(k / 12)).otherwise(F.ceil(k / 12)).cast("int")

    k = months(expiry)
    days = F.datediff(expiry, F.add_months(start, k))
    up = years(k) + F.when((k % 12 == 11) & (days >= 1), 1).otherwise(0)
    return F.greatest(up, years(months(F.date_add(expiry, 30)))).cast("double")

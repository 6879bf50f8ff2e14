"""Same postal address written differently.

Probabilistic record linkage. Both sides are parsed into the same components: flat, number, words
(building, street, town; abbreviations folded into one spelling) and postcode. Candidates come from
blocks: the postcode, or the sound of the street's name with its kind, or (for addresses without a
postcode) the sound of two neighbouring words, always together with the flat, number or building sound.
Each candidate is compared component by component; the levels include "missing on one side" and
"nothing there on both". The weights of the levels are estimated by expectation-maximization over the
counts of the comparison patterns, and give each pair its probability of being a match. By definition a match
is the same flat, if any, at the same number: the share of matches with another flat, a flat on the address
alone or another number is not estimated but held at `SLIP`, what misreading leaves. The estimated weights
alone decide: the most probable premises of an address are taken if their probability is `probability` or more.

Scale. Addresses are linked once per distinct spelling, so copies cost nothing. One shuffle joins the
block keys; both sides carry their parsed components, so nothing is looked up again. A key with more
than `max_block` premises (or so many more that no more than `most_hot` keys have them, which bounds the broadcast
that marks them) is salted: its premises are dealt over parts of about `max_block`, its addresses go to every part.
So every pair of a block is compared, however full it is, and no task holds a hot block alone. EM runs on the pattern counts, whose number is bounded by the levels, not by the data.

Defined results. A row without any address has no match; one of two address fields may be null or
blank. Premises without uprn are left out. Equally probable premises are all given. Repeated rows
give one row per id and premises. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demesne.common import cut

#: Spellings of one word; the first stands for all (fixed values). HILL and HALL share an abbreviation,
#: as STREET and SAINT do; the words around them tell them apart.
SAME = """
STREET ST STR SAINT|ROAD RD|LANE LN LA|COURT CT CRT|CLOSE CL CLS CLO|CRESCENT CRES CRESC CR CRS|DRIVE DR DRV|AVENUE AV AVE AVN
GARDENS GDNS GARDEN GDN GDS GRDNS|GROVE GR GRV GRO|PLACE PL PLC|SQUARE SQ SQR|TERRACE TERR TER TCE TERRC|HALL HL HILL|WAY WY|WALK WK
HOUSE HO HSE HS|LODGE LDG LDGE|TOWER TWR TOW|MANSIONS MANS MANSION MNS|HEIGHTS HTS HGTS HEIGHT|POINT PT PNT|COTTAGE COTT CTG COT COTTS
VILLA VLA|FARM FM FRM|BARN BN|PARK PK PRK|BUILDINGS BUILDING BLDG BLDGS|UPPER UPR UP|LOWER LWR LR|NORTH NTH N|SOUTH STH S|EAST E|WEST W
GREAT GT|LITTLE LT|MOUNT MT|BANK BK|FIELD FLD|VIEW VW|MOOR MR|QUAY QY|GATE GTE|BROOK BRK|MILL ML|STONE STN
"""
FOLD = {w: group.split()[0] for group in re.split(r"[|\n]", SAME) if group.strip() for w in group.split()}
STREET_KINDS = set("STREET ROAD LANE COURT CLOSE CRESCENT DRIVE AVENUE GARDENS GROVE PLACE SQUARE TERRACE HALL WAY WALK".split())
BUILDING_KINDS = set("HOUSE LODGE TOWER MANSIONS HEIGHTS POINT COTTAGE VILLA FARM BARN COURT HALL".split())
KINDS = STREET_KINDS | BUILDING_KINDS
_FULL_KINDS = [w for w in FOLD if len(w) >= 4 and FOLD[w] in KINDS]

_POSTCODE = re.compile(r"\b([A-Z]{1,2}\d[A-Z\d]?)\s*(\d[A-Z]{2})\b")
_INTRO = re.compile(r"^\s*(?:THE\s+)?(?:(?:PREMISES|PROPERTY|DWELLING)\s+KNOWN\s+AS|(?:LAND|DEMISE|PREMISES|PROPERTY|DWELLING)(?:\s+AND\s+BUILDINGS?)?\s+(?:AT|BEING|KNOWN AS)|ALL THAT)\s+")
_ORDINAL = {"GROUND": "GROUND", "GRD": "GROUND", "GRND": "GROUND", "GND": "GROUND", "G": "GROUND", "FIRST": "FIRST", "1ST": "FIRST", "SECOND": "SECOND", "2ND": "SECOND", "THIRD": "THIRD", "3RD": "THIRD", "FOURTH": "FOURTH", "4TH": "FOURTH", "TOP": "TOP", "BASEMENT": "BASEMENT", "BSMT": "BASEMENT", "LOWER": "LOWER", "UPPER": "UPPER"}
_FLAT_WORD = r"(?:FLAT|FLT|FT|APARTMENT|APRTMENT|APT|APPT|UNIT|MAISONETTE|STUDIO|ROOM|SUITE)"
_FLOOR = re.compile(rf"(?:\b{_FLAT_WORD}\s+)?\b({'|'.join(sorted(_ORDINAL, key=len, reverse=True))})\s+(?:FLOOR|FLR|FL)\b(?:\s+{_FLAT_WORD}\b)?")
_FLAT = re.compile(rf"\b{_FLAT_WORD}\s+(?:NO\s+|NUMBER\s+)?(\d+[A-Z]?|[A-Z])\b")
_LETTER = re.compile(r"\bNO\s+([A-Z])\b")
_RANGE = re.compile(r"\b(\d+[A-Z]?)\s*(?:-|/|–|&|\bAND\b|\bTO\b)\s*(\d+[A-Z]?)\b")
_NUMBER = re.compile(r"^\d+[A-Z]?(?:-\d+[A-Z]?)?$")


_PLAIN = {**{c: " " for c in range(128) if not (chr(c).isalnum() or chr(c) in "&/-'")}, ord("'"): None, 0x2019: None, 0x2013: "-"}
_STRANGE = re.compile(r"[^A-Z0-9&/-]+")
_SIGNS = re.compile(r"[&/]")
_NUMBER_LETTER = re.compile(r"\b(\d+) ([A-H])\b(?= [A-Z]{2})")
_SMALL = {"NO", "NUMBER", "THE", "AT", "AND", "OF", "DWELLING"}


def normal(text: str | None) -> str:
    t = (text or "").upper().translate(_PLAIN)
    if not t.isascii():
        t = _STRANGE.sub(" ", t)
    return " ".join(t.split())


def name_words(text: str | None) -> list[str]:
    """Folded words of a street, town or locality."""
    return [fold(w) for w in normal(text).split()]


def fold(word: str) -> str:
    """The standing spelling of a word; a misspelt kind of street or building counts as that kind."""
    w = FOLD.get(word)
    return w if w is not None else _near_kind(word)


@lru_cache(200_000)
def _near_kind(word: str) -> str:
    if len(word) >= 5:
        for k in _FULL_KINDS:
            if abs(len(k) - len(word)) <= 1 and k[0] == word[0] and edits(word, k, 1) == 1:
                return FOLD[k]
    return word


@lru_cache(400_000)
def edits(a: str, b: str, most: int) -> int:
    """Damerau-Levenshtein distance (neighbouring letters swapped count one), at most `most` + 1."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [0] * (len(b) + 1), list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, before, row = before, row, [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], last[j - 2] + 1)
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def alike(a: str, b: str) -> int:
    """2 for the same word, 1 for a likely misspelling, else 0."""
    if a == b:
        return 2
    n = min(len(a), len(b))
    most = 1 if n < 8 else 2
    if n < 3 or abs(len(a) - len(b)) > most or (a[0] != b[0] and a[-1] != b[-1]):
        return 0
    return 1 if edits(a, b, most) <= most else 0


_CODES = str.maketrans("BFPVCGJKQSXZDTLMNR", "111122222222334556")


@lru_cache(200_000)
def sound(word: str) -> str:
    """First letter and three digits of the consonants that follow."""
    if not word:
        return ""
    out, last = word[0], word[0].translate(_CODES)
    for c in word[1:]:
        code = c.translate(_CODES)
        if code.isdigit() and code != last:
            out += code
        if c not in "HW":
            last = code
    return (out + "000")[:4]


def parse(text: str | None) -> tuple[str, list[str], list[str], str] | None:
    """(flat, bare numbers, folded words in order, postcode), None for an empty address.

    A bare number is written number@place, the place being that of the word it stands before.
    """
    t = normal(text)
    if not t:
        return None
    found = list(_POSTCODE.finditer(t))
    code = found[-1].group(1) + found[-1].group(2) if found else ""
    if found:
        t = f"{t[: found[-1].start()]} {t[found[-1].end() :]}".strip()
    if t[:2] in ("TH", "LA", "DE", "PR", "DW", "AL"):
        t = _INTRO.sub("", t)
    flat = ""
    m = _FLOOR.search(t) if " FL" in t else None
    if m:
        flat = f"{_ORDINAL[m.group(1)]} FLOOR"
        t = f"{t[: m.start()]} {t[m.end() :]}"
    else:
        m = _FLAT.search(t) or (_LETTER.search(t) if "NO " in t else None)
        if m:
            flat = m.group(1).lstrip("0") or m.group(1)
            t = f"{t[: m.start()]} {t[m.end() :]}"
    if _SIGNS.search(t) or "-" in t or " AND " in t or " TO " in t:
        t = _SIGNS.sub(" ", _RANGE.sub(r"\1-\2", t))
    numbers, words = [], []
    for w in _NUMBER_LETTER.sub(r"\1\2", t).split():
        if w[0].isdigit():
            w = w.strip("-")
            if _NUMBER.match(w):
                numbers.append(f"{w.lstrip('0') or w}@{len(words)}")
            else:
                words.append(fold(w))
        elif w not in _SMALL and (w := w.strip("-")):
            words.append(fold(w))
    return flat, numbers, words, code


def bare(number: str) -> str:
    return number.split("@")[0]


def premises(sub, bname, number, street, dep_street, town, locality, postcode) -> tuple[str, str, list[str], list[str], list[str], list[str], str]:
    """(flat, number, building, street, town, locality, postcode) of a gazetteer entry, wherever its parts stand."""
    flat, num, building = "", "", []
    p = parse(sub)
    if p:
        flat = p[0] or (bare(p[1][0]) if p[1] else "")
        building += [] if flat else p[2]
    num = normal(number).replace(" ", "")
    num = (num.lstrip("0") or num) if _NUMBER.match(num) else ""
    b = parse(bname)
    if b:
        building += b[2]
        for x in ([b[0]] if b[0] else []) + [bare(v) for v in b[1]]:
            if b[2] and not flat:
                flat = x
            elif not num:
                num = x
    code = _SIGNS.sub("", normal(postcode)).replace(" ", "").replace("-", "")
    return flat, num, building, name_words(dep_street) or name_words(street), name_words(town), name_words(locality), code


def block_keys(codes: list[str], idents: list[str], streets: list[str], towns: list[str], pairs: list[str]) -> list[str]:
    """Postcode keys; street keys, each with a postcode area or (towns, '?') where one side has no postcode; pair keys."""
    areas = [c[:-3] for c in codes] + towns
    out = [f"P|{c}|{i}" for c in codes for i in idents]
    out += [f"S|{s}|{a}|{i}" for s in streets for a in areas for i in idents]
    return list(dict.fromkeys(out + [f"W|{w}|{i}" for w in pairs for i in idents]))


def _street_sounds(words: list[str]) -> list[str]:
    return [sound(words[i - 1]) + w for i, w in enumerate(words) if i and w in STREET_KINDS]


def _pair_sounds(words: list[str]) -> list[str]:
    return [sound(a) + sound(b) for a, b in zip(words, words[1:], strict=False)]


def address_keys(parsed: list[tuple]) -> list[str]:
    """Block keys of an address in one or two spellings."""
    flats = [p[0] for p in parsed if p[0]]
    codes = list(dict.fromkeys(p[3] for p in parsed if p[3]))
    keys: list[str] = []
    for _, placed, words, _ in parsed:
        numbers = [bare(x) for x in placed]
        if flats:
            idents = [f"F{f}" for f in flats]
        else:
            idents = [f"F{x}" for x in numbers] + [f"N{y}" for x in numbers for y in dict.fromkeys([x, *x.split("-")])]
            if len(numbers) <= 1:
                idents += [f"B{sound(w)}" for w in words]
        idents = list(dict.fromkeys(idents))
        towns = ["?"] if codes else list(dict.fromkeys("=" + sound(w) for w in words))
        keys += block_keys(codes, idents, _street_sounds(words), towns, [] if codes else _pair_sounds(words))
    return list(dict.fromkeys(keys))


def premises_keys(g: tuple) -> list[str]:
    flat, num, building, street, town, _, code = g
    idents = [f"F{flat}"] if flat else ([f"N{num}"] if num else []) + ([f"B{sound(building[0])}"] if building else [])
    towns = ["=" + sound(town[-1])] if town else []
    return block_keys([code] if len(code) > 3 else [], idents, _street_sounds(street), towns if code else [*towns, "?"], _pair_sounds(building) or _pair_sounds(street))


# ---------------------------------------------------------------- comparison

#: Per component, the levels; a pattern is one letter per component.
LEVELS = {"flat": "andx", "number": "apmndx", "building": "afmnd", "street": "afmnd", "town": "afmnd", "code": "afmnd"}
# a agrees, f nearly (misspelt), p part of a range, m missing on one side, n nothing on either, d differs, x only the address has it


def _find(part: list[str], words: list[str], used: set[int], least: int = 1) -> tuple[str, int]:
    """(a, f or '', place) of the part standing in the words, in one run; marks what it uses.

    Without its kind (of street or building) a part must have `least` words left.
    """
    n, head = len(part), part[0]
    first, final = head[0], head[-1]
    begins = []
    for i, w in enumerate(words):
        if w == head:
            if words[i : i + n] == part and used.isdisjoint(range(i, i + n)):
                used.update(range(i, i + n))
                return "a", i
            begins.append(i)
        elif (w[0] == first or w[-1] == final) and alike(head, w):
            begins.append(i)
    for i in begins:
        if i + n <= len(words) and all(alike(part[j], words[i + j]) for j in range(1, n)) and used.isdisjoint(range(i, i + n)):
            used.update(range(i, i + n))
            return "f", i
    if n > least and part[-1] in KINDS:  # without its kind, unless another kind stands there
        for i in begins:
            if i + n - 1 <= len(words) and all(alike(part[j], words[i + j]) for j in range(1, n - 1)) and used.isdisjoint(range(i, i + n - 1)) and not (i + n - 1 < len(words) and words[i + n - 1] in KINDS):
                used.update(range(i, i + n - 1))
                return "f", i
    return "", -1


def compare(address: tuple, g: tuple) -> str:
    """The pattern of one spelling of an address against premises.

    What a bare number is follows from what it stands before: the street makes it the number, the
    building or another number the flat.
    """
    flat, placed, words, code = address
    gflat, gnum, building, street, town, locality, gcode = g
    used: set[int] = set()
    levels, at = {}, {}
    for name, part in (("building", building), ("street", street), ("town", town)):
        levels[name], at[name] = _find(part, words, used, 2 if name == "building" else 1) if part else ("n", -1)
    if locality:
        _find(locality, words, used)
    left = len(words) - len(used)
    for name, level in levels.items():
        if not level:
            levels[name] = "d" if left else "m"

    rest = []  # (number, role): s before the street, b before the building, u before a number, o before something else
    for k, x in enumerate(placed):
        value, place = x.split("@")
        if k + 1 < len(placed) and placed[k + 1].endswith("@" + place):
            role = "u"
        else:
            role = "s" if int(place) == at["street"] else "b" if int(place) == at["building"] else "o"
        rest.append((value, role))

    def take(fits) -> bool:
        for k, x in enumerate(rest):
            if fits(*x):
                del rest[k]
                return True
        return False

    of_number = "s" if at["street"] >= 0 else "so"
    if flat:
        of_number += "b"
    num = ""
    if gnum:
        if take(lambda v, r: v == gnum and r in of_number):
            num = "a"
        elif take(lambda v, r: r in of_number and (gnum in v.split("-") or v in gnum.split("-"))):
            num = "p"
        else:
            num = "d" if any(r == "s" for _, r in rest) else "m"
    elif any(r == "s" for _, r in rest):
        num = "x"
        take(lambda v, r: r == "s")
    else:
        num = "n"
    if flat:
        fl = ("a" if flat == gflat else "d") if gflat else "x"
    elif gflat:
        fl = "a" if take(lambda v, r: v == gflat and r in "buo") else "d"
    else:
        fl = "x" if rest else "n"
    c = "n" if not code and not gcode else "m" if not code or not gcode else "a" if code == gcode else "f" if edits(code, gcode, 1) == 1 else "d"
    return fl + num + levels["building"] + levels["street"] + levels["town"] + c


_ORDER = [{c: i for i, c in enumerate("axnd")}] + [{c: i for i, c in enumerate("anpfmxd")}] * 5


def merged(patterns: list[str]) -> str:
    """The better level of each component over the spellings of one address; a flat that one of them names counts."""
    return "".join(min(p, key=lambda c: o[c]) for p, o in zip(zip(*patterns, strict=True), _ORDER, strict=True))


def compared_all(spellings: tuple, g: tuple) -> str:
    """The pattern over all spellings; a first one that agrees throughout settles it."""
    first = compare(spellings[0], g)
    if len(spellings) == 1 or (first[0] == "a" and all(c in "an" for c in first)):
        return first
    return merged([first, *[compare(p, g) for p in spellings[1:]]])


# ---------------------------------------------------------------- expectation-maximization


#: Levels that no match has by definition, and the share of matches that have them for all that, by misreading.
CONTRARY = {"flat": "dx", "number": "d"}
SLIP = 1e-6


def estimate(counts: dict[str, int], rounds: int = 50, strength: float = 20.0) -> dict[str, float]:
    """Log odds of a match for every pattern: two classes, components independent within a class.

    What is believed beforehand weighs as much as `strength` pairs of each class, which only matters in small tables.
    """
    if not counts:
        return {}
    pats = sorted(counts)
    n = np.array([counts[p] for p in pats], float)
    names = list(LEVELS)
    onehot = [np.array([[c == x for x in LEVELS[name]] for c in (p[k] for p in pats)], float) for k, name in enumerate(names)]
    contrary = [np.array([x in CONTRARY.get(name, "") for x in LEVELS[name]]) for name in names]
    believed = {"a": (0.85, 0.2), "f": (0.1, 0.02), "p": (0.05, 0.02), "m": (0.1, 0.1), "n": (0.5, 0.2), "d": (0.01, 0.5), "x": (0.01, 0.1)}

    def shares(v: np.ndarray, never: np.ndarray) -> np.ndarray:
        v = np.where(never, 0, v)
        return np.where(never, SLIP, v / v.sum())

    m0 = [shares(np.array([believed[x][0] for x in LEVELS[name]]), never) for name, never in zip(names, contrary, strict=True)]
    u0 = [np.array([believed[x][1] for x in LEVELS[name]]) for name in names]
    u0 = [v / v.sum() for v in u0]
    m, u = m0, [(o.T @ n + strength * v) / (n.sum() + strength) for o, v in zip(onehot, u0, strict=True)]
    share = 0.3
    p = np.zeros(len(pats))
    for _ in range(rounds):
        weight = np.log(share / (1 - share)) + sum(o @ (np.log(v) - np.log(w)) for o, v, w in zip(onehot, m, u, strict=True))
        new = 1 / (1 + np.exp(-np.clip(weight, -500, 500)))
        done, p = np.abs(new - p).max() < 1e-6, new
        if done:
            break
        share = float(((p * n).sum() + 0.3 * strength) / (n.sum() + strength))
        m = [shares(o.T @ (p * n) + strength * v, never) for o, v, never in zip(onehot, m0, contrary, strict=True)]
        u = [(o.T @ ((1 - p) * n) + strength * v) / (((1 - p) * n).sum() + strength) for o, v in zip(onehot, u0, strict=True)]
    return {pat: float(w) for pat, w in zip(pats, weight, strict=True)}


# ---------------------------------------------------------------- linkage

_G = "uprn long, keys array<string>, flat string, num string, building string, street string, town string, locality string, code string"


def _parsed_premises(gazetteer: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row in b.itertuples(index=False):
                g = premises(*row[1:])
                out.append((row[0], premises_keys(g), g[0], g[1], *[" ".join(x) for x in g[2:6]], g[6]))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _G.split(", ")])

    columns = ["sub_building_name", "building_name", "building_number", "thoroughfare", "dependent_thoroughfare", "post_town", "dependent_locality", "postcode"]
    return gazetteer.select(F.col("uprn").cast("long").alias("uprn"), *columns).filter("uprn IS NOT NULL").distinct().mapInPandas(run, _G)


def _parsed_addresses(leases: DataFrame) -> DataFrame:
    def pack(p: tuple | None) -> str | None:
        return None if p is None else "\t".join([p[0], " ".join(p[1]), " ".join(p[2]), p[3]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for akey, rpd, apd in zip(b["akey"], b["rpd"], b["apd"], strict=True):
                both = [p for p in (parse(rpd), parse(apd)) if p]
                if both:
                    out.append((akey, address_keys(both), "\n".join(pack(p) for p in both)))
            yield pd.DataFrame(out, columns=["akey", "keys", "spelt"])

    return leases.select("akey", "rpd", "apd").dropDuplicates(["akey"]).mapInPandas(run, "akey binary, keys array<string>, spelt string")


def _compare_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    @lru_cache(20_000)
    def unpack(spelt: str) -> tuple:
        return tuple((f, n.split(), w.split(), c) for f, n, w, c in (line.split("\t") for line in spelt.split("\n")))

    for b in batches:
        out = []
        for akey, spelt, uprn, flat, num, building, street, town, locality, code in b.itertuples(index=False):
            g = (flat, num, building.split(), street.split(), town.split(), locality.split(), code)
            pattern = compared_all(unpack(spelt), g)
            out.append((akey, uprn, pattern))
        yield pd.DataFrame(out, columns=["akey", "uprn", "pattern"])


def link(leases: DataFrame, gazetteer: DataFrame, id_column: str = "_id", max_block: int = 2_000, probability: float = 0.01, most_hot: int = 20_000) -> DataFrame:
    """(lease_id, uprn, pattern, weight): the premises each address denotes; weight is the log odds of a match.

    `probability` is low because it is a pair's, before it is known that the address has no better premises.
    """
    spark = leases.sparkSession
    akey = F.unhex(F.md5(F.concat_ws("\x1f", F.coalesce("rpd", F.lit("")), F.coalesce("apd", F.lit("")))))
    rows = leases.select(F.col(id_column).alias("lease_id"), akey.alias("akey"), "rpd", "apd").filter(F.col("lease_id").isNotNull())
    a = _parsed_addresses(rows).select("akey", "spelt", F.explode("keys").alias("key"))
    g = cut(_parsed_premises(gazetteer))
    parts = ["flat", "num", "building", "street", "town", "locality", "code"]
    keyed = g.select("uprn", *parts, F.explode("keys").alias("key"))
    # no more than `most_hot` keys can be that full, which bounds this broadcast; a premises has a dozen keys at most
    max_block = max(max_block, math.ceil(12 * g.count() / most_hot))
    hot = F.broadcast(keyed.groupBy("key").count().filter(F.col("count") > max_block).select("key", F.ceil(F.col("count") / max_block).cast("int").alias("salts")))
    salts = F.coalesce("salts", F.lit(1))

    def salted(df: DataFrame, salt: Column) -> DataFrame:
        return df.join(hot, "key", "left").withColumn("salt", salt).drop("salts")

    # premises with the address's postcode are met by that; the street key is for all others
    twice = F.col("key").startswith("S|") & (F.col("code") != "") & F.contains("spelt", F.concat(F.lit("\t"), "code"))
    pairs = salted(a, F.explode(F.sequence(F.lit(0), salts - 1))).join(salted(keyed, F.pmod(F.hash("uprn"), salts)), ["key", "salt"]).filter(~twice).select("akey", "spelt", "uprn", *parts)
    compared = pairs.mapInPandas(_compare_batches, "akey binary, uprn long, pattern string")
    best = cut(compared.distinct())
    counts = {r["pattern"]: r["count"] for r in best.groupBy("pattern").count().collect()}
    weights = [(p, w) for p, w in estimate(counts).items() if w >= math.log(probability / (1 - probability))]
    told = spark.createDataFrame(weights or [("", 0.0)], "pattern string, weight double")
    # the patterns are bounded by the levels of the components
    likely = best.join(F.broadcast(told), "pattern")
    top = likely.withColumn("k", F.rank().over(Window.partitionBy("akey").orderBy(F.desc(F.round("weight", 9))))).filter("k = 1")
    return rows.select("lease_id", "akey").join(top.select("akey", "uprn", "pattern", "weight").distinct(), "akey").select("lease_id", "uprn", "pattern", "weight")

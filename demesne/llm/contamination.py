"""Evaluation texts leaking into training text.

Size-partitioned MinHash containment search. The items' shingles that are not stock (those that at most
`stock_items` items share) form the queries. Documents are cut into windows of at most `window`
shingles, over their whole length; windows are partitioned by size, and for each size class the
containment threshold is turned into a Jaccard threshold, from which the number of bands follows (one
row per band: the sought similarity is low). The item of a block that needs most bands, which is the
shortest, sets their number, so that the recall holds for every item of the block. A window and an item
are candidates if any of these minima agree. Each candidate is verified exactly on the whole document: containment of the item's own
shingles, and the share of the item's words that stand in the document in order in at most two
stretches.

Scale. One pass over the documents without a shuffle. The items are the stated query set: their own
shingles are worked out by a join, and they are taken in blocks of at most `block_items`, whose index (bands x
items x 16 bytes) is broadcast, so neither a broadcast nor what the driver holds exceeds that bound however many
items there are. Items of any length need at most some 560 bands at the standing parameters. A block is a pass
over the documents. Verification is linear in the document: of stretches that cover the same words of an item, the first
and the last are enough.

Defined results. Null and empty texts and items hold nothing. An item of fewer words than a shingle is
one shingle. Items whose shingles are all stock are matched on all their shingles. Copies of a
document or of an item are reported each. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demesne.common import cut
from demesne.llm.text import hashed, shingles, words

SHINGLE = 5


@lru_cache(4)
def permutations(n: int) -> np.ndarray:
    """(n, 2): factors and summands; the first of them are the same whatever n is."""
    p = np.random.default_rng(20_240_117).integers(0, 2**63, (n, 2), dtype=np.uint64)
    p[:, 0] |= np.uint64(1)
    return p


def bands_needed(window: int, query: int, containment: float, recall: float, most: int | None = None) -> int:
    """Minima to compare so that an item of `query` shingles with this containment in such a window is met.

    No item is met by less than one shingle.
    """
    shared = min(query, max(1.0, containment * query))
    j = shared / max(window + query - shared, shared)
    need = 1 if j >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - j))
    return need if most is None else min(need, most)


def minima(s: np.ndarray, starts: np.ndarray, bands: int) -> np.ndarray:
    """(bands, windows): the minimum of each permuted hash over each run of shingles."""
    out = np.empty((bands, len(starts)), np.uint32)
    for j, (a, b) in enumerate(permutations(bands)):
        out[j] = np.minimum.reduceat(((s * a + b) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    return (np.arange(len(m), dtype=np.uint64)[:, None] << np.uint64(32)) | m.astype(np.uint64)


class ItemIndex:
    """One block of items: word hashes, own shingles and their minima in sorted order."""

    def __init__(self, ids: list[int], texts: list[str | None], stock: set[int], windows: tuple[int, ...], containment: float, recall: float, most: int | None = None, own_of: list[np.ndarray] | None = None) -> None:
        self.ids, self.words, self.own = [], [], []
        for k, (i, text) in enumerate(zip(ids, texts, strict=True)):
            h = hashed(words(text))
            if not len(h):
                continue
            s = np.unique(shingles(h, SHINGLE))
            if own_of is not None:
                own = np.sort(own_of[k])
            else:
                own = s[~np.isin(s, np.fromiter(stock, np.uint64, len(stock)))] if stock else s
            self.ids.append(i)
            self.words.append(h)
            self.own.append(own if len(own) else s)
        sizes = {len(o) for o in self.own}
        self.bands_of = {w: max((bands_needed(w, n, containment, recall, most) for n in sizes), default=1) for w in windows}
        if self.own:
            bands = max(self.bands_of.values())
            starts = np.cumsum([0] + [len(o) for o in self.own[:-1]])
            keys = band_keys(minima(np.concatenate(self.own), starts, bands))
            flat, item = keys.ravel(), np.tile(np.arange(len(self.ids)), bands)
            order = np.argsort(flat, kind="stable")
            self.keys, self.items = flat[order], item[order]
        else:
            self.keys, self.items = np.empty(0, np.uint64), np.empty(0, int)

    def candidates(self, keys: np.ndarray, window_doc: np.ndarray) -> dict[int, set[int]]:
        """Items per document; keys is (bands, windows)."""
        flat = keys.ravel()
        lo, hi = np.searchsorted(self.keys, flat, "left"), np.searchsorted(self.keys, flat, "right")
        out: dict[int, set[int]] = {}
        for k in np.flatnonzero(hi > lo):
            out.setdefault(int(window_doc[k % keys.shape[1]]), set()).update(self.items[lo[k] : hi[k]].tolist())
        return out


def stretches(item: np.ndarray, doc: np.ndarray, seed: int = 3, drift: int = 3, gap: int = 12, agreeing: float = 0.75) -> list[tuple[int, int, int, int]]:
    """(item from, item to, doc from, doc to) of the runs in which the item stands in the document.

    Seeds are common runs of `seed` words; seeds on about the same diagonal with few words between them
    join. A run grows at its ends over single changed words. It counts if enough of its words agree.
    """
    si, sd = shingles(item, seed), shingles(doc, seed)
    if not len(si) or not len(sd):
        return []
    order = np.argsort(si, kind="stable")
    lo, hi = np.searchsorted(si[order], sd, "left"), np.searchsorted(si[order], sd, "right")
    seeds = sorted((int(q) - int(p), int(q), int(p)) for q in np.flatnonzero(hi > lo) for p in order[lo[q] : hi[q]])
    runs: list[list[int]] = []  # item from, item to, doc from, doc to, diagonal
    open_: list[list[int]] = []
    for d, q, p in sorted(seeds, key=lambda s: s[1]):
        best = None
        open_ = [r for r in open_ if q - r[3] <= gap]
        for r in open_:
            if abs(d - r[4]) <= drift and p >= r[0] and p + seed > r[1] - seed and p - r[1] <= gap and (best is None or abs(d - r[4]) < abs(d - best[4])):
                best = r
        if best is None:
            best = [p, p + seed, q, q + seed, d]
            runs.append(best)
            open_.append(best)
        else:
            best[1], best[3], best[4] = max(best[1], p + seed), max(best[3], q + seed), d
    out = []
    for p0, p1, q0, q1, _ in runs:
        while p0 > 1 and q0 > 1 and item[p0 - 2] == doc[q0 - 2]:
            step = 1 if item[p0 - 1] == doc[q0 - 1] else 2
            p0, q0 = p0 - step, q0 - step
        while p1 + 1 < len(item) and q1 + 1 < len(doc) and item[p1 + 1] == doc[q1 + 1]:
            step = 1 if item[p1] == doc[q1] else 2
            p1, q1 = p1 + step, q1 + step
        p1, q1 = min(p1, len(item)), min(q1, len(doc))
        share = np.isin(item[p0:p1], doc[q0:q1]).mean()
        if share >= agreeing:
            out.append((p0, p1, q0, q1))
    return out


def coverage(runs: list[tuple[int, int, int, int]]) -> tuple[int, int]:
    """(words, stretches): the most item words in one or two stretches that follow one another in both texts."""
    best = (0, 0)
    ends: dict[tuple[int, int], int] = {}  # part of the item: where its first stretch ends
    begins: dict[tuple[int, int], int] = {}  # where its last stretch begins
    for p0, p1, q0, q1 in runs:
        best = max(best, (p1 - p0, -1))
        ends[p0, p1] = min(q1, ends.get((p0, p1), q1))
        begins[p0, p1] = max(q0, begins.get((p0, p1), q0))
    for (a0, a1), end in ends.items():
        for (b0, b1), begin in begins.items():
            if a0 < b0 and a1 <= b0 + 2 and end <= begin + 2:
                best = max(best, (b1 - max(b0, a1) + a1 - a0, -2))
    return best[0], -best[1]


def _search(index, window: int, containment: float, covered: float, slice_words: int):
    def flush(ids: list, texts: list[np.ndarray]) -> pd.DataFrame:
        idx: ItemIndex = index.value
        classes = sorted(idx.bands_of)
        found: dict[int, set[int]] = {}
        sh = [shingles(t, SHINGLE) for t in texts]
        for at, size in enumerate(classes):
            smaller = classes[at - 1] if at else 0
            parts, starts, owner, pos = [], [], [], 0
            for d, s in enumerate(sh):
                if not len(s):
                    continue
                n = max(1, math.ceil(len(s) / window))
                step = math.ceil(len(s) / n)
                if not smaller < step <= size:
                    continue
                parts.append(s)
                cuts = np.arange(0, len(s), step)
                starts.append(cuts + pos)
                owner.append(np.full(len(cuts), d))
                pos += len(s)
            if parts:
                keys = band_keys(minima(np.concatenate(parts), np.concatenate(starts), idx.bands_of[size]))
                for d, items in idx.candidates(keys, np.concatenate(owner)).items():
                    found.setdefault(d, set()).update(items)
        out = []
        for d, items in found.items():
            here = np.unique(sh[d])
            for i in items:
                own = idx.own[i]
                at = np.minimum(np.searchsorted(here, own), len(here) - 1)
                share = float((here[at] == own).mean())
                if share < containment:
                    continue
                n, k = coverage(stretches(idx.words[i], texts[d]))
                if n >= covered * len(idx.words[i]):
                    out.append((idx.ids[i], ids[d], share, n / len(idx.words[i]), k))
        return pd.DataFrame(out, columns=["item_id", "doc_id", "containment", "covered", "n_stretches"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(batch["doc_id"], batch["text"], strict=True):
                h = hashed(words(t))
                ids.append(i)
                texts.append(h)
                size += len(h)
                if size >= slice_words:
                    yield flush(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield flush(ids, texts)

    return run


def leaked_items(documents: DataFrame, items: DataFrame, containment: float = 0.18, covered: float = 0.4, stock_items: int = 2, window: int = 96, bands: int | None = None, recall: float = 0.995, block_items: int = 5_000, slice_words: int = 400_000) -> DataFrame:
    """(item_id, doc_id, containment, covered, n_stretches): the items of which a document holds a good part.

    `containment` is the share of the item's own five-word shingles that a document must hold, `covered`
    the share of its words that must stand there in at most two stretches. `bands`, if given, caps the
    minima compared; short items may then fall below `recall`.
    """
    spark = documents.sparkSession
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    blocks = max(1, math.ceil(asked.count() / (0.8 * block_items)))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")

    def item_shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = [np.unique(shingles(hashed(words(t)), SHINGLE)).view(np.int64) for t in b["text"]]
            yield pd.DataFrame({"row": np.repeat(b["row"].to_numpy(np.int64), [len(x) for x in s]), "s": np.concatenate(s) if s else np.empty(0, np.int64)})

    rows = cut(asked.withColumns({"row": F.monotonically_increasing_id(), "block": F.pmod(F.xxhash64("item_id"), F.lit(blocks))}))
    pairs = rows.select("row", "text").mapInPandas(item_shingles, "row long, s long")
    rare = pairs.groupBy("s").count().filter(F.col("count") <= stock_items).select("s")
    own = pairs.join(rare, "s").groupBy("row").agg(F.collect_list("s").alias("own"))  # an item's shingles, no more
    rows = cut(rows.join(own, "row", "left"))
    found = []
    for k in range(blocks):
        here = rows.filter(F.col("block") == k).toPandas().sort_values(["item_id", "row"])
        owned = [np.array(x if x is not None else [], np.int64).view(np.uint64) for x in here["own"]]
        index = ItemIndex(here["item_id"].tolist(), here["text"].tolist(), set(), (window // 4, window // 2, window), containment / 2, recall, bands, owned)
        find = _search(spark.sparkContext.broadcast(index), window, containment, covered, slice_words)
        found.append(docs.mapInPandas(find, "item_id long, doc_id long, containment double, covered double, n_stretches int"))
    return reduce(DataFrame.unionAll, found)

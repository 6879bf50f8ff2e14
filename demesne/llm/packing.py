"""Filling fixed-capacity containers with texts.

Hierarchical packing by several context sizes. The capacity, halved a few times, gives the tiers; a text belongs
to the smallest tier that holds it. Tier by tier, from the longest, texts are packed longest first into windows of
the tier's own size. A text goes into the fullest window that still holds it, be it of its own tier or the gap
that a longer window has left, and only if there is none a window of its tier's size is opened. So short texts
share short windows, which a step can attend over at a fraction of the cost of long ones, and the gaps of
long windows are filled from the shorter tiers. Windows are nested into containers of the one capacity: as each size
halves the one before, they leave no space between them, but in the last container. Containers are dealt to step groups so that the groups' attention costs (sum of squared lengths)
are balanced.

A text is cut only if it alone exceeds the capacity, into as few pieces as possible; cuts fall on token
boundaries that are also character boundaries, and the pieces, joined, are the text.

Scale. Sizes, not texts, are packed. Texts are dealt by hash to shards of about `shard_containers`
containers; each shard packs on its own. Containers that a shard leaves emptier than `full` are opened
again and packed together in a second round over fewer shards, which at last leaves about one open
container per shard of that round. No task sees more than a shard, whatever the number of texts.

Defined results. Null and empty texts have no tokens; they take a place in a container at no cost.
Copies are packed each. Rows with a null doc_id are left out, for a piece could not be traced. An empty
table gives no containers. Extra columns are ignored. The capacity must be at least 8.
"""

from __future__ import annotations

import base64
import math
import os
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demesne.common import cut

#: Where the public vocabularies lie; a parameter of every function here.
TOKENIZER = os.environ.get("DEMESNE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: The split pattern that belongs to the byte-level vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LOADED: dict[str, object] = {}


def tokenizer(path: str):
    """The vocabulary as an encoding, loaded once per process."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _LOADED[path] = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def pieces(text: str, capacity: int, enc) -> list[tuple[int, int, int]]:
    """(from, to, tokens) in characters, covering the text, each of at most `capacity` tokens."""
    tokens = enc.encode_ordinary(text)
    if len(tokens) <= capacity:
        return [(0, len(text), len(tokens))]
    sizes = np.array([len(b) for b in enc.decode_tokens_bytes(tokens)])
    ends = np.cumsum(sizes)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    begins_char = np.r_[(raw & 0xC0) != 0x80, True]
    chars = np.cumsum(begins_char) - 1  # character number at a byte that begins one
    ok = begins_char[ends]
    out, at, start = [], 0, 0
    while at < len(tokens):
        stop = min(at + capacity, len(tokens))
        while stop > at + 1 and stop < len(tokens) and not ok[stop - 1]:
            stop -= 1
        end = int(chars[ends[stop - 1]]) if stop < len(tokens) else len(text)
        n = len(enc.encode_ordinary(text[start:end]))
        while n > capacity and stop > at + 1:  # a cut can change how its neighbourhood is merged
            stop -= max(1, n - capacity)
            while stop > at + 1 and not ok[stop - 1]:
                stop -= 1
            end = int(chars[ends[stop - 1]])
            n = len(enc.encode_ordinary(text[start:end]))
        out.append((start, end, n))
        at, start = stop, end
    return [p for p in out if p[1] > p[0]]


def measured(documents: DataFrame, capacity: int, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, piece_no, char_from, char_to, n_tokens): one row per text, or per piece of one that is too long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = tokenizer(path)
        for b in batches:
            out = []
            for doc, text in zip(b["doc_id"], b["text"], strict=True):
                if not text:
                    out.append((doc, 0, 0, 0, 0))
                else:
                    out += [(doc, k, *p) for k, p in enumerate(pieces(text, capacity, enc))]
            yield pd.DataFrame(out, columns=["doc_id", "piece_no", "char_from", "char_to", "n_tokens"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    return docs.mapInPandas(run, "doc_id long, piece_no int, char_from int, char_to int, n_tokens int")


def tier_sizes(capacity: int, tiers: int) -> list[int]:
    return [max(1, capacity >> k) for k in range(tiers)]


def pack(sizes: np.ndarray, capacity: int, tiers: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(container, window, tier of the window) of each item. Windows are numbered; tier k has windows of capacity / 2^k."""
    limits = tier_sizes(capacity, tiers)
    tier = np.zeros(len(sizes), np.int32)
    for k, limit in enumerate(limits):
        tier[sizes <= limit] = k
    home = np.full(len(sizes), -1, np.int64)
    gaps: list[tuple[int, int]] = []  # (room, window), sorted
    opened: list[int] = []  # tier of each window
    for k in range(tiers):
        mine = np.flatnonzero(tier == k)
        for i in mine[np.argsort(-sizes[mine], kind="stable")]:
            n = int(sizes[i])
            at = bisect_left(gaps, (n, -1))
            if at < len(gaps):
                room, w = gaps.pop(at)
            else:
                room, w = limits[k], len(opened)
                opened.append(k)
            home[i] = w
            if room > n:
                insort(gaps, (room - n, w))
    # windows come in order of size, so each container is filled to the brim by windows that follow one another
    size = np.array(limits, np.int64)[opened] if opened else np.empty(0, np.int64)
    container = np.empty(len(opened), np.int64)
    room, made = 0, -1
    for w, n in enumerate(size):
        if room < n:
            made, room = made + 1, capacity
        container[w], room = made, room - n
    at = np.array(opened, np.int32) if opened else np.empty(0, np.int32)
    return container[home], home, at[home]


def _pack_shards(capacity: int, tiers: int, round_no: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id", "piece_no"], ascending=[False, True, True], kind="stable", ignore_index=True)
        home, window, tier = pack(pdf["n_tokens"].to_numpy(np.int64), capacity, tiers)
        filled = np.bincount(home, pdf["n_tokens"].to_numpy(float)) if len(home) else np.empty(0)
        shard = int(pdf["shard"].iloc[0])
        return pdf.assign(container=[f"{round_no}-{shard}-{c}" for c in home], window=window.astype(np.int32), tier=tier, filled=filled[home].astype(np.int64))

    return run


def _deal(group_size: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Containers in order of cost are dealt back and forth over the groups."""
        cost = pdf.assign(cost=pdf["n_tokens"].astype(float) ** 2).groupby("container", sort=True)["cost"].sum().sort_values(ascending=False, kind="stable")
        groups = max(1, math.ceil(len(cost) / group_size))
        lap, spot = np.divmod(np.arange(len(cost)), groups)
        group = dict(zip(cost.index, np.where(lap % 2 == 0, spot, groups - 1 - spot), strict=True))
        bucket = str(pdf["bucket"].iloc[0])
        return pdf.assign(step_group=[f"{bucket}-{group[c]}" for c in pdf["container"]])

    return run


_PACKED = "doc_id long, piece_no int, char_from int, char_to int, n_tokens int, row long, shard int, container string, window int, tier int, filled long"


def packed(documents: DataFrame, capacity: int = 2048, tiers: int = 4, path: str = TOKENIZER, group_size: int = 8, shard_containers: int = 4_000, full: float = 0.98) -> DataFrame:
    """(container, step_group, window, tier, doc_id, piece_no, char_from, char_to, n_tokens, filled), a row per text or piece.

    window numbers the windows of a container's shard; tier k has windows of capacity / 2^k tokens.
   """
    if capacity < 8:
        raise ValueError("the capacity must be at least 8 tokens")
    items = cut(measured(documents, capacity, path).withColumn("row", F.monotonically_increasing_id()))

    def shards(df: DataFrame) -> int:
        t = df.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
        return max(1, math.ceil(t["t"] / (capacity * shard_containers)), math.ceil(t["n"] / (64 * shard_containers)))

    def one_round(df: DataFrame, n: int, round_no: int) -> DataFrame:
        shard = F.pmod(F.xxhash64("row", F.lit(round_no)), F.lit(n)).cast("int")
        return df.select("doc_id", "piece_no", "char_from", "char_to", "n_tokens", "row", shard.alias("shard")).groupBy("shard").applyInPandas(_pack_shards(capacity, tiers, round_no), _PACKED)

    first = cut(one_round(items, shards(items), 1))
    poor = first.filter(F.col("filled") < full * capacity)
    again = one_round(poor, shards(poor), 2)
    both = first.filter(F.col("filled") >= full * capacity).unionAll(again)
    bucket = F.pmod(F.xxhash64("container"), F.lit(shards(items))).cast("int")
    out = both.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(_deal(group_size), f"{_PACKED}, bucket int, step_group string")
    return out.select("container", "step_group", "window", "tier", "doc_id", "piece_no", "char_from", "char_to", "n_tokens", "filled")


def fill_report(assigned: DataFrame, capacity: int) -> DataFrame:
    """One row: containers, texts, tokens, unused space, containers over the least possible, and how even the step groups are.

    attended_share is the attention cost of the windows over that of containers attended over whole.
    """
    windows = assigned.groupBy("step_group", "container", "window", "tier").agg(F.sum("n_tokens").alias("used"), F.sum(F.col("n_tokens").cast("double") ** 2).alias("cost"), F.count("*").alias("n"))
    per = windows.groupBy("step_group", "container").agg(F.sum("used").alias("used"), F.sum("cost").alias("cost"), F.sum("n").alias("n"), F.sum(F.pow(F.lit(4.0), -F.col("tier"))).alias("attended"))
    groups = per.groupBy("step_group").agg(F.sum("used").alias("used"), F.sum("cost").alias("cost"), F.count("*").alias("containers"), F.sum("n").alias("n"), F.sum("attended").alias("attended"))
    least = F.ceil(F.sum("used") / capacity)
    return groups.agg(
        F.sum("containers").alias("n_containers"),
        least.alias("least_containers"),
        F.sum("n").alias("n_pieces"),
        F.sum("used").alias("n_tokens"),
        F.round(1 - F.sum("used") / (F.sum("containers") * capacity), 6).alias("unused_share"),
        F.round(F.sum("attended") / F.sum("containers"), 6).alias("attended_share"),
        F.round(F.max(F.col("cost") / F.col("containers")) / F.avg(F.col("cost") / F.col("containers")), 6).alias("worst_group_cost"),
    )

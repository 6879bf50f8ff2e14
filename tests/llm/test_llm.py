"""The corpus operators on small fixtures: brute force, round trips, held-out accuracy and edge cases."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from demesne.llm import addresses, contamination, language, packing
from demesne.llm.text import hashed, shingles, words

# ---------------------------------------------------------------- P3


@pytest.mark.parametrize(
    "text,want",
    [
        ("Flat 3, Vesper Pk House, Cygnet Lane, Giskingwick (QA12  7QZ)", ("3", [], ["VESPER", "PARK", "HOUSE", "CYGNET", "LANE", "GISKINGWICK"], "QA127QZ")),
        ("PINDOWTON; FLAT, TOP FLR; 6 CANDLE LA.", ("TOP FLOOR", ["6@1"], ["PINDOWTON", "CANDLE", "LANE"], "")),
        ("33 & 35 Plover Cresc", ("", ["33-35@0"], ["PLOVER", "CRESCENT"], "")),
        ("Land and buildings at 24 B Teasel Crescent", ("", ["24B@0"], ["TEASEL", "CRESCENT"], "")),
        ("", None),
        (None, None),
    ],
)
def test_parse_address(text, want):
    assert addresses.parse(text) == want


def _gazetteer(spark):
    rows = [
        (1, "FLAT 1", "OPAL HALL", None, "COPPER HILL", None, "TARN", None, "QA1 1AA", 0),
        (2, "FLAT 2", "OPAL HALL", None, "COPPER HILL", None, "TARN", None, "QA1 1AA", 0),
        (3, None, "3 OPAL HALL", None, "COPPER HILL", None, "TARN", None, "QA1 1AA", 0),
        (4, None, None, "1", "COPPER HILL", None, "TARN", None, "QA1 1AA", 0),
        (5, None, "7-9", None, None, "REED GROVE", "TARN", None, None, 0),
        (5, None, None, "7", None, "REED GROVE", "TARN", None, None, 0),
        (6, "FLAT A", None, "12", "REED GROVE", None, "TARN", None, "QA1 2BB", 0),
        (None, None, None, "14", "REED GROVE", None, "TARN", None, "QA1 2BB", 0),
    ]
    return spark.createDataFrame(rows, "uprn long, sub_building_name string, building_name string, building_number string, thoroughfare string, dependent_thoroughfare string, post_town string, dependent_locality string, postcode string, key int")


def test_links(spark):
    rows = [
        ("a", "Apt 1, Opal Hl, Coppre Hill (QA1 1AA)", None, 1),
        ("b", None, "2 OPAL HALL, COPPER HILL, TARN", 1),
        ("c", "Copper Hill, No. 3, Opal Hl, Tarn", "", 1),
        ("d", "1 Copper Hill, Tarn QA11AA", "1 COPPER HL", 1),
        ("e", "7/9 Reed Gr, Tarn", None, 1),
        ("f", "Flat A, 12 Reed Grove, Tarn", None, 1),
        ("g", "12 Reed Grove, Tarn QA1 2BB", None, 1),  # the house, not its flat
        ("h", "Flat 9, Opal Hall, Copper Hill, Tarn QA1 1AA", None, 1),
        ("i", None, None, 1),
        ("a", "Apt 1, Opal Hl, Coppre Hill (QA1 1AA)", None, 1),
    ]
    leases = spark.createDataFrame(rows, "_id string, rpd string, apd string, key int")
    got = {(r["lease_id"], r["uprn"]) for r in addresses.link(leases, _gazetteer(spark), probability=1e-3).select("lease_id", "uprn").distinct().collect()}
    assert got == {("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5), ("f", 6)}
    hot = {(r["lease_id"], r["uprn"]) for r in addresses.link(leases, _gazetteer(spark), probability=1e-3, max_block=1).select("lease_id", "uprn").distinct().collect()}
    assert hot == got
    assert addresses.link(leases.limit(0), _gazetteer(spark)).count() == 0
    assert addresses.link(leases, _gazetteer(spark).limit(0)).count() == 0


def test_full_blocks_are_compared_whole(spark):
    """A misspelt building and no street: only the postcode and flat lead to the premises, in a full block too."""
    rows = [(i, "FLAT 1", f"{name} HALL", None, f"{name} LANE", None, "TARN", None, "QA1 1AA", 0) for i, name in enumerate(["OPAL", "BRIAR", "CEDAR", "DAMSON", "FENNEL"], 1)]
    gaz = spark.createDataFrame(rows, _gazetteer(spark).schema)
    leases = spark.createDataFrame([("a", "Flat 1, Opsl Hall QA1 1AA", None)], "_id string, rpd string, apd string")
    assert addresses.sound("OPSL") != addresses.sound("OPAL")
    pairs = [{tuple(r) for r in addresses.link(leases, gaz, probability=1e-3, max_block=n).select("lease_id", "uprn").collect()} for n in (2_000, 2, 1)]
    assert pairs == [{("a", 1)}] * 3


def test_linkage_against_known_references(spark, sf):
    """Leases that carry a reference tell whether the address alone would have found it."""
    known = spark.read.parquet(f"{sf}/leases.parquet").filter("uprn IS NOT NULL")
    gaz = spark.read.parquet(f"{sf}/ab_plus.parquet")
    found = addresses.link(known, gaz).select("lease_id", "uprn").distinct()
    truth = known.select(F.col("_id").alias("lease_id"), F.col("uprn").alias("true_uprn")).distinct().join(gaz.select(F.col("uprn").alias("true_uprn")).distinct(), "true_uprn")
    right = truth.join(found, "lease_id").filter("uprn = true_uprn").count()
    assert right >= 0.97 * truth.count()


# ---------------------------------------------------------------- P6

needs_tokenizer = pytest.mark.skipif(not Path(packing.TOKENIZER).exists(), reason="no vocabulary")


@needs_tokenizer
def test_packing_round_trip(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(2, 9)))
    texts = [" ".join(word() for _ in range(int(rnd.paretovariate(1) * 6) % 400)) for _ in range(300)]
    texts += ["é漢字😀" * 200, "x" * 5000, "", None, "a b", "a b"]
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(texts)] + [(None, "lost", "c", 1)], "doc_id long, text string, container string, tier int")
    rows = packing.packed(df, capacity=64, shard_containers=20).collect()
    enc = packing.tokenizer(packing.TOKENIZER)
    used, per = {}, {}
    for r in rows:
        used[r["container"]] = used.get(r["container"], 0) + r["n_tokens"]
        per.setdefault(r["doc_id"], []).append(r)
    assert max(used.values()) <= 64 and set(per) == set(range(len(texts)))
    for i, t in enumerate(texts):
        ps = sorted(per[i], key=lambda r: r["piece_no"])
        assert "".join((t or "")[p["char_from"] : p["char_to"]] for p in ps) == (t or "")
        whole = len(enc.encode_ordinary(t or ""))
        assert (len(ps) == 1) == (whole <= 64)
        assert all(p["n_tokens"] == len(enc.encode_ordinary((t or "")[p["char_from"] : p["char_to"]])) for p in ps)
    assert sum(used.values()) / (64 * len(used)) > 0.93
    assert packing.packed(df.limit(0), capacity=64).count() == 0


@pytest.mark.parametrize("tiers", [1, 2, 4])
def test_pack_never_overfills_and_fills_gaps(tiers):
    rnd = np.random.default_rng(1)
    sizes = rnd.integers(0, 101, 2000)
    home, window, tier = packing.pack(sizes, 100, tiers)
    load = np.bincount(home, sizes)
    assert load.max() <= 100 and len(load) <= np.ceil(sizes.sum() / 100) * 1.03
    assert all(np.bincount(window, sizes)[w] <= packing.tier_sizes(100, tiers)[t] for w, t in zip(window, tier, strict=True))
    assert all(len(set(home[window == w])) == 1 for w in set(window))


def test_short_texts_share_short_windows():
    """Half the tokens are in short texts: with tiers they stand in short windows, without in windows of the whole capacity."""
    sizes = np.r_[np.full(50, 88), np.full(900, 4)]
    home, _, tier = packing.pack(sizes, 96, 4)
    assert np.bincount(home, sizes).max() <= 96 and home.max() + 1 <= 1.02 * np.ceil(sizes.sum() / 96)
    assert (tier[50:] == 0).sum() == 100 and (tier[50:] == 3).sum() == 800  # two fill the gap of each long window, the others go to windows of 12
    assert set(packing.pack(sizes, 96, 1)[2]) == {0}


def test_containers_come_close_to_the_least_possible():
    rnd = np.random.default_rng(5)
    sizes = np.minimum((rnd.pareto(1.1, 20_000) * 60).astype(int) + 5, 2048)
    tiered, plain = packing.pack(sizes, 2048, 4)[0].max() + 1, packing.pack(sizes, 2048, 1)[0].max() + 1
    least = np.ceil(sizes.sum() / 2048)
    assert plain <= least * 1.01 and tiered <= least * 1.02


# ---------------------------------------------------------------- P7

ITEM = "The tribunal sat in March 1984 and cut the claim from 1547 pounds to 954 and awarded O Ferraby costs for 8 hearings . Nobody collected rent between June 1986 and July 1990 so arrears of 1440 built up across 45 accounts ."
OTHER = "The tribunal sat in June 1971 and cut the claim from 88 pounds to 12 and awarded Z Quill costs for 3 hearings . Convert the measure of 51 perches and 6 feet recorded by A Bramnall in 1995 into square metres please ."
FILL = "Rent is payable on the usual quarter days and rises every five years from the date of the lease . "


def test_leaks(spark):
    w = ITEM.split()
    half = " ".join(w[:20])
    docs = {
        1: FILL * 60 + ITEM + FILL * 60,
        2: "<p>" + ITEM.upper().replace(" ", " \n> ") + "</p>",
        3: FILL + " ".join(w[2:12]) + " " + FILL + " ".join(w[26:38]) + FILL,
        4: " ".join("changed" if i % 9 == 4 else x for i, x in enumerate(w)),
        5: FILL * 30,
        6: "The tribunal sat in May 1999 and cut the claim from 7 pounds to 3 and awarded K Wyn costs for 2 hearings . " + FILL,  # the phrases of both items, the facts of neither
        12: OTHER.split(" . ")[0] + FILL,  # the first half of the other item
        7: "",
        8: None,
        9: " ".join(w[:8]),
        10: ITEM,
        11: half + FILL,
    }
    df = spark.createDataFrame([(k, v, 1.0) for k, v in docs.items()], "doc_id long, text string, containment double")
    items = spark.createDataFrame([(100, ITEM), (200, OTHER), (300, None), (400, "")], "item_id long, text string")
    got = {(r["item_id"], r["doc_id"]) for r in contamination.leaked_items(df, items).collect()}
    assert got == {(100, 1), (100, 2), (100, 3), (100, 4), (100, 10), (100, 11), (200, 12)}
    blocks = {(r["item_id"], r["doc_id"]) for r in contamination.leaked_items(df, items, block_items=1).collect()}
    assert blocks == got
    assert contamination.leaked_items(df.limit(0), items).count() == 0 == contamination.leaked_items(df, items.limit(0)).count()


def test_search_meets_exact_containment(spark, sf):
    """Every pair that exact containment finds is found by the search."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/evalitems.parquet")
    got = {(r["item_id"], r["doc_id"]) for r in contamination.leaked_items(docs, items).collect()}
    hashes = {r["item_id"]: hashed(words(r["text"])) for r in items.collect()}
    counts = {}
    for h in hashes.values():
        for s in np.unique(shingles(h, 5)):
            counts[s] = counts.get(s, 0) + 1
    own = {i: np.array([s for s in np.unique(shingles(h, 5)) if counts[s] <= 2], np.uint64) for i, h in hashes.items()}
    want = set()
    for r in docs.collect():
        h = hashed(words(r["text"]))
        here = np.unique(shingles(h, 5))
        for i, o in own.items():
            if len(here) and np.isin(o, here).mean() >= 0.18 and contamination.coverage(contamination.stretches(hashes[i], h))[0] >= 0.4 * len(hashes[i]):
                want.add((i, r["doc_id"]))
    assert got == want


def test_coverage_against_all_pairs():
    rnd = random.Random(6)
    for _ in range(300):
        runs = []
        for _ in range(rnd.randrange(1, 9)):
            p, q, n = rnd.randrange(30), rnd.randrange(60), rnd.randrange(3, 12)
            runs.append((p, p + n, q, q + n))
        want = max([(r[1] - r[0], -1) for r in runs] + [(b[1] - max(b[0], a[1]) + a[1] - a[0], -2) for a in runs for b in runs if a[0] < b[0] and a[1] <= b[0] + 2 and a[3] <= b[2] + 2])
        assert contamination.coverage(runs) == (want[0], -want[1])


def test_short_items_beside_a_long_one_are_met():
    """The recall holds for every item of a block: short items are not searched with the few bands of a long one."""
    rnd = np.random.default_rng(7)
    text = lambda n: " ".join(f"w{x}" for x in rnd.integers(0, 10**9, n))
    short = [text(24) for _ in range(400)]  # 20 shingles each
    docs = [" ".join(s.split()[:8]) + " " + text(88) for s in short]  # 4 of them, in a window of 92
    items = [*short, text(2_004)]
    index = contamination.ItemIndex(list(range(401)), items, set(), (24, 48, 96), 0.09, 0.995)
    assert all(index.bands_of[w] >= contamination.bands_needed(w, len(o), 0.09, 0.995) for w in (24, 48, 96) for o in index.own)
    sh = [shingles(hashed(words(d)), 5) for d in docs]
    keys = contamination.band_keys(contamination.minima(np.concatenate(sh), np.cumsum([0] + [len(s) for s in sh[:-1]]), index.bands_of[96]))
    found = index.candidates(keys, np.arange(400))
    assert sum(i in found.get(i, ()) for i in range(400)) >= 0.995 * 400


@pytest.mark.parametrize("n", [1, 5, 11, 12, 53, 2_000])
def test_bands_reach_the_recall(n):
    bands, shared = contamination.bands_needed(96, n, 0.09, 0.995), min(n, max(1, 0.09 * n))
    assert 1 - (1 - shared / (96 + n - shared)) ** bands >= 0.995


# ---------------------------------------------------------------- P8


@pytest.mark.parametrize("label,want", [("en-GB", "en"), (" EN ", "en"), ("Welsh", "cy"), ("cym", "cy"), ("Français", "fr"), ("und", None), ("", None), (None, None), ("n/a", None)])
def test_labels(spark, label, want):
    assert language.language_of_label(label) == want
    assert spark.createDataFrame([(label,)], "l string").select(language.label_code(F.col("l"))).first()[0] == want


def test_sentences_keep_initials_and_wrapped_lines():
    assert language.sentences("Ask K. Ruvlam now. It is\nso.\n\nNew part") == ["Ask K. Ruvlam now.", "It is\nso.", "New part"]
    assert language.sentences(None) == language.sentences(" \n ") == []


def _enough(sf):
    """The smallest tables hold too few sentences of the rare languages to learn from."""
    more = sf.replace("sf0.001", "sf0.01")
    return more if Path(more).exists() else sf


def test_identify(spark, sf):
    sf = _enough(sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.fit(docs.select("doc_id", "text", "lang"))
    en = "The tenant must repair the internal walls throughout the term. The meeting agreed that the roof contract be given to the local tender."
    fr = "Veuillez adresser l'avis de cession avant la date prévue. L'assemblée a décidé de repeindre le hall pendant l'été."
    cy = "Rhaid i'r tenant gadw'r waliau mewnol mewn cyflwr da trwy gydol y tymor. Nid oes hawl i isosod yr eiddo heb ganiatâd ysgrifenedig y cwmni."
    rows = [(1, en, "en-GB"), (2, fr, "en"), (3, f"{en} {cy} {en}", "English"), (4, "12 34 []", None), (5, None, "en"), (6, "", "en"), (7, en, None), (8, f'{en} The deed is marked "prydles hon" in pencil.', "en")]
    df = spark.createDataFrame([(a, b, c, 5) for a, b, c in rows], "doc_id long, text string, lang string, seg_no int")
    got = {tuple(r) for r in language.corrections(language.identify(df, model)).collect()}
    assert got == {(2, 0, "fr"), (3, 1, "en"), (3, 2, "cy"), (3, 3, "en"), (7, 0, "en")}
    assert language.identify(df.limit(0), model).count() == 0
    assert all(0.5 <= r["confidence"] <= 1 for r in language.identify(df, model).collect())


def test_copies_of_a_sentence_are_learned_once(spark, monkeypatch):
    """The bound on the sentences that go to the driver holds however often one is copied, and a copied one is never lost."""
    copied = "The tenant must repair the internal walls throughout the term."
    rows = [(i, copied, "en") for i in range(2_000)] + [(2_000 + i, f"The tenant of house {'abcdefghij'[i]} must keep the garden in order.", "en-GB") for i in range(10)]
    learned = []
    monkeypatch.setattr(language, "train", lambda texts, labels, *_: learned.append(list(zip(texts, labels.tolist(), strict=True))))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    language.fit(df, sample=4_000)
    assert len(learned[0]) == len(set(learned[0])) == 11
    language.fit(df, sample=20)
    assert copied in dict(learned[1]) and len(learned[1]) <= 11


def test_a_tenth_of_the_draws_gives_the_same_languages(spark, sf):
    """The model does not depend on how many sentences were drawn."""
    docs = spark.read.parquet(f"{_enough(sf)}/documents.parquet")
    some, more = language.fit(docs, sample=80), language.fit(docs, sample=800)
    texts = sorted({s for r in docs.collect() for s in language.sentences(r["text"]) if len(s) >= 30})
    assert (some.classify(texts)[0] == more.classify(texts)[0]).mean() > 0.99


def test_cosines_are_those_of_the_vectors():
    texts = ["The lease of the flat", "", "12 34", "y brydles \u201chon\u201d", "\u00c9t\u00e9 \U0001f600 \u0130stanbul stra\u00dfe", "a"]
    idf, rnd = np.linspace(0.5, 3, 1 << 10), np.random.default_rng(3)
    m = language.Model(idf, rnd.random((1 << 10, 4)), np.arange(4), np.zeros(7))
    assert np.allclose(m.cosines(texts), language.similarities(language.vectors(texts, idf), len(texts), m.centroids), atol=1e-5)


def test_held_out_accuracy(spark, sf):
    """Trained on one half of the labelled sentences, the other half is told right where labels agree with all neighbours."""
    docs = [r for r in spark.read.parquet(f"{_enough(sf)}/documents.parquet").collect() if r["text"] and language.language_of_label(r["lang"])]
    idf = np.ones(1 << 13)
    part = lambda k: [(s, language.LANGUAGES.index(language.language_of_label(r["lang"]))) for i, r in enumerate(docs) if i % 2 == k for s in language.sentences(r["text"]) if len(s) >= 40]
    train, held = part(0), part(1)
    model = language.train([s for s, _ in train], np.array([k for _, k in train]), idf, 3)
    told, _ = model.classify([s for s, _ in held])
    assert np.mean(told == np.array([k for _, k in held])) > 0.85  # labels themselves are noisy


def test_model_without_training_data():
    model = language.train([], np.empty(0, int), np.ones(1 << 13), 3)
    assert language.LANGUAGES[model.classify(["the lease of the flat and the house"])[0][0]] == "en"

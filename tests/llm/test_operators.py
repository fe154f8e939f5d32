"""Corpus operators against brute force, and their defined results for odd rows."""

import hashlib
import json
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
import xxhash

from rowmill.llm import (
    bpe, chat, components, decontamination, imatch, quality, sharding, simhash, token_counts, toxicity, url_filter,
)
from rowmill.llm.queries import BYTES, PIECES
from rowmill.session import fresh_path, session_settings

SCHEMA = "doc_id long, text string, __text string, ids string, n_tokens string, size int"
ODD = [
    (1, None), (2, ""), (3, "  two  spaces "), (3, "  two  spaces "), (None, "no key"), (None, "no key"),
    (4, "x" * 300), (5, "a b c d e f g h " * 2000), (6, "▁ ▁▁"), (7, "<|endoftext|>it's<|endoftext|>"),
    (8, "\n\n\t é 日本語 😀 ²³"), (9, "Word"), (10, "<s></s>[INST]"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Every operator meets NULLs, empty and long texts, repeated rows and clashing column names."""
    return spark.createDataFrame([(k, t, "other", "clash", "clash", 1) for k, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def noise(seed: int, words: int, letters: str = "abcdefgh") -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(letters, k=draw.randint(2, 7))) for _ in range(words))


def bag(frame, *columns):
    return sorted((tuple(row) for row in frame.select(*columns).collect()), key=repr)


def test_token_counts_equal_the_library(spark, odd, empty):
    path, cache = public_tokenizers.path(PIECES), fresh_path(spark, "test-cache")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    expected = sorted(((k, len((t or "").encode()), len(library.encode(t or ""))) for k, t in ODD), key=repr)
    assert bag(token_counts.count_tokens(odd, path, cache), "doc_id", "n_bytes", "n_tokens") == expected
    stored = spark.read.parquet(cache).count()
    assert stored == len({t or "" for _, t in ODD})
    # All content is known now: the counts come from the cache, which does not grow.
    assert bag(token_counts.count_tokens(odd, path, cache), "doc_id", "n_bytes", "n_tokens") == expected
    assert spark.read.parquet(cache).count() == stored
    assert token_counts.count_tokens(empty, path, cache).count() == 0


def test_cache_keeps_tokenizer_versions_apart(spark, odd, tmp_path):
    cache = fresh_path(spark, "test-versions")
    token_counts.count_tokens(odd, public_tokenizers.path(PIECES), cache).count()
    assert token_counts.read_cache(spark, cache, "another version").count() == 0


def test_bpe_equals_the_library_and_decodes(odd, empty):
    path = public_tokenizers.path(BYTES)
    library = tokenizers.Tokenizer.from_file(path)
    rows = [(r.doc_id, list(r.ids), r.decoded) for r in bpe.encode_texts(odd, path).collect()]
    expected = [(k, library.encode(t or "", add_special_tokens=False).ids, t or "") for k, t in ODD]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
    again = bpe.decode_ids(bpe.encode_texts(odd, path).drop("decoded"), path)
    assert bag(again, "doc_id", "decoded") == sorted(((k, t or "") for k, t in ODD), key=repr)
    assert bpe.encode_texts(empty, path).count() == 0


def test_trie_gives_every_token_itself_and_random_words_their_ids():
    path = public_tokenizers.path(BYTES)
    pairs, library = bpe.BytePairs(path), tokenizers.Tokenizer.from_file(path)
    own = {token: number for number, token in pairs.tokens.items() if number not in pairs.special.values()}
    assert all(ids == [own[word]] for word, ids in pairs.encode_words(iter(own)))
    draw = random.Random(3)
    words = {"".join(draw.choices("aehinorst", k=draw.randint(1, 25))) for _ in range(3000)}
    found = {w.decode(): ids for w, ids in pairs.encode_words(w.encode() for w in words)}
    assert found == {w: library.encode(w).ids for w in words}


def test_rendezvous_moves_few_records(spark, odd, empty):
    frame = spark.range(20_000).selectExpr("id as doc_id", "cast(id as string) as text")
    placed = sharding.shard_records(frame, [1.0, 2.0, 1.0], 1.0).toPandas()
    assert set(placed.loc[placed["shard"] != placed["grown_shard"], "grown_shard"]) == {3}
    shares = placed["shard"].value_counts(normalize=True)
    assert abs(shares[1] - 0.5) < 0.02 and abs(shares[0] - 0.25) < 0.02
    assert all(sorted(slots) == list(range(len(slots))) for _, slots in placed.groupby("shard")["slot"])
    found = sharding.shard_records(odd, [1.0] * 4, 1.0).toPandas()
    assert len(found) == len(ODD) and found.loc[found["doc_id"] == 1, ["size", "text_crc32"]].values.tolist() == [[16, 0]]
    assert found[found["doc_id"].isna()]["shard"].nunique() == 1
    assert all(sorted(slots) == list(range(len(slots))) for _, slots in found.groupby("shard")["slot"])
    assert sharding.shard_records(empty, [1.0], 1.0).count() == 0
    with pytest.raises(ValueError):
        sharding.rendezvous_shard(frame["doc_id"], [])


def test_a_key_that_owns_the_table_keeps_gapless_slots(spark):
    frame = spark.range(5000, numPartitions=8).selectExpr("7 as doc_id", "'same' as text")
    slots = sharding.shard_records(frame, [1.0, 1.0], 1.0).toPandas()["slot"]
    assert sorted(slots) == list(range(5000))


def brute_components(prints: dict, radius: int = 4) -> dict:
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: find(k) for k in keys}


def test_simhash_fingerprints_and_components(spark, odd, empty):
    base = noise(1, 300)
    texts = {i: base.replace(base.split()[i], "edit", 1) if i else base for i in range(12)}
    texts |= {20 + i: noise(i + 5, 30) for i in range(30)} | {60: "", 61: " \n", 62: "One", 63: "one", 64: None}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    prints = {}
    for key, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(run.encode(), 42) for run in runs]
        prints[key] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    found = {r.doc_id: r for r in simhash.near_duplicates(frame).collect()}
    assert {k: r.fingerprint % (1 << 64) for k, r in found.items()} == prints
    assert {k: r.component for k, r in found.items()} == brute_components(prints)
    assert found[61].component == 60 == found[64].component
    assert simhash.near_duplicates(odd).count() == len(ODD) and simhash.near_duplicates(empty).count() == 0


def test_masks_cover_every_pair_within_the_radius():
    masks, draw = simhash.covering_masks(4), random.Random(2)
    assert len(masks) == 31 and all(mask.bit_count() == 32 for mask in masks)
    for _ in range(2000):
        apart = sum(1 << b for b in draw.sample(range(64), draw.randint(1, 4)))
        assert any(not apart & mask for mask in masks)


def test_crowded_bucket_in_blocks_loses_no_link(spark):
    draw = random.Random(4)
    values = {sum(1 << b for b in draw.sample(range(14), draw.randint(0, 3))) for _ in range(900)}
    values |= {(1 << 40) | value for value in list(values)[:50]} | {draw.getrandbits(63) for _ in range(200)}
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    links = simhash.near_links(frame, 4, block=16)
    roots = {r.node: r.root for r in components.connected(links, "a", "b").collect()}
    expected = brute_components({v: v for v in values})
    assert {v: roots.get(v, v) for v in values} == expected


def test_links_hold_across_the_sign_bit(spark):
    """Fingerprints that differ in bit 63, of which one is negative as a long, in buckets of three and in crowded ones."""
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    draw, top = random.Random(6), 1 << 63
    low = {sum(1 << b for b in draw.sample(range(14), draw.randint(0, 3))) for _ in range(300)}
    # Half of them have bit 63; those further off are joined to the others by nothing but that bit.
    far = {(1 << 45) - 1 << 16 | v << 1 for v in list(low)[:20]}
    crowd = {v | top if i % 2 else v for i, v in enumerate(sorted(low | far))} | {v ^ top for v in far}
    for values in ({0, 1, top + 2}, crowd):
        frame = spark.createDataFrame([(signed(v),) for v in values], "fingerprint long")
        links = simhash.near_links(frame, 4, block=16)
        roots = {r.node: r.root for r in components.connected(links, "a", "b").collect()}
        groups, expected = {}, {}
        for v in values:
            groups.setdefault(roots.get(signed(v), signed(v)), set()).add(v)
        for v, root in brute_components({v: v for v in values}).items():
            expected.setdefault(root, set()).add(v)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101 + i) for i in range(200)] + [(500, 500), (None, 3), (7, 8)]
    frame = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.root for r in components.connected(frame, "a", "b").collect()}
    assert found == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(201)}
    assert components.connected(frame.where("a = 500"), "a", "b").count() == 0


def test_imatch_follows_the_contract(spark, odd, empty):
    texts = [(i, noise(i, 40 + 7 * i)) for i in range(30)] + [(40, ""), (41, None), (42, noise(3, 61)), (None, "last")]
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    rows = {r.doc_id: r for r in imatch.compare_edited(frame, imatch.lexicon(frame)).collect()}
    order = sorted((t for t in texts if t[0] is not None), reverse=True) + [(None, "last")]
    for (key, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + after[:third]
        assert rows[key].n_chars == len(text)
        assert rows[key].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
    assert rows[42].fingerprint == rows[3].fingerprint and rows[40].fingerprint == rows[41].fingerprint
    assert np.mean([rows[i].near_edited for i in range(30)]) > 0.2 > 0.05 > np.mean([rows[i].near_next for i in range(30)])
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows.values())
    assert bag(imatch.fingerprints(frame, imatch.lexicon(frame)), "fingerprint") == sorted((r.fingerprint,) for r in rows.values())
    assert imatch.compare_edited(odd, imatch.lexicon(odd)).count() == len(ODD)
    assert imatch.compare_edited(empty, imatch.lexicon(empty)).count() == 0
    one = imatch.compare_edited(frame.where("doc_id = 5"), imatch.lexicon(frame)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_imatch_splits_a_hot_key_and_reads_long_texts(spark):
    """One key owns most rows, half of them copies of one text; a text of 3 MB shrinks to almost nothing."""
    rows = [(7, "the same words again")] * 40 + [(7, noise(i, 30)) for i in range(40)] + [(9, "ab " * 1_000_000), (1, "end")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    with session_settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        found = imatch.compare_edited(frame, imatch.lexicon(frame)).collect()
    assert sorted(r.n_chars for r in found) == sorted(len(t) for _, t in rows)
    # Copies follow each other, but for the last one of them.
    same = [r for r in found if r.n_chars == len("the same words again") and r.near_next == 1.0]
    assert len({r.fingerprint for r in same}) == 1 and len(same) >= 39
    last = next(r for r in found if r.doc_id == 1)
    assert last.edited_sha256 == hashlib.sha256(b"ena").hexdigest()


def test_imatch_edited_copies_of_a_hot_group_stay_alike(spark):
    """A text that owns a third of the rows has no word in the lexicon, what its edited form ends with has."""
    copy = noise(70, 120)
    rows = [(3 * i, copy) for i in range(60)] + [(3 * i + k, noise(100 + 3 * i + k, 120)) for i in range(60) for k in (1, 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    band = imatch.lexicon(frame)
    terms, _ = imatch.distinct_terms([copy])
    assert len(band) and not np.isin(terms, band).any()
    found = imatch.compare_edited(frame, band).collect()
    hot = [r.near_edited for r in found if r.doc_id % 3 == 0]
    assert len(hot) == 60 and np.mean(hot) > 0.2 and sorted(hot)[5] > 0
    assert np.mean([r.near_next for r in found if r.doc_id % 3 == 2]) < 0.1


def test_imatch_tells_small_changes_of_long_texts():
    """Some tier holds about one term of a text of 5,000 or 50,000 terms in each subset."""
    for n in (5_000, 50_000):
        words = [f"w{n}x{i}" for i in range(n)]
        band = np.sort(imatch.distinct_terms([" ".join(words)])[0])
        texts, changed = [], []
        for k in range(6):
            texts.append(" ".join(words) + f" own{k}")
            changed.append(" ".join(w if i % 5 != k % 5 else f"new{k}y{i}" for i, w in enumerate(words)))
        own, other = (imatch.prints_of(some, band) for some in (texts, changed))
        assert np.mean(imatch.likeness(own, other)) > 0.4


def test_lexicon_counts_every_document(spark):
    frame = spark.createDataFrame([(i, f"all word{i % 5} own{i}") for i in range(100)], "doc_id long, text string")
    assert len(imatch.lexicon(frame, low=1.0, high=4.0)) == 5
    assert len(imatch.lexicon(frame, low=0.0, high=9.0)) == 106


def test_decontamination_tolerates_substitutions(spark, odd, empty):
    item, short = noise(50, 40), "seven words make up this short item"
    words = item.split()
    swapped = " ".join("zzz" if i % 7 == 3 else w for i, w in enumerate(words))
    texts = {
        1: f"{noise(1, 30)} {item.upper()}! {noise(2, 30)}", 2: f"{noise(3, 90)} {swapped}", 3: noise(4, 500),
        4: " ".join(words[10:30]), 5: " ".join(words[:9]), 6: f"so: {short}.", 7: "seven words make up", 8: None, 9: "",
        10: " ".join("zzz" if i % 2 else w for i, w in enumerate(words)),
    }
    docs = spark.createDataFrame([(k, t, 1) for k, t in texts.items()] * 2, "doc_id long, text string, item_id int")
    tests = spark.createDataFrame([(1, item), (2, short), (3, None), (4, "too short"), (1, item)], "item_id long, text string")
    rows = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(docs, tests).collect()}
    assert set(rows) == {(1, 1), (2, 1), (4, 1), (6, 2)}
    assert rows[1, 1].words == rows[1, 1].equal == 40 and rows[1, 1].doc_from == 30
    # Words 3, 10, ..., 38 are replaced: three words before the first do not pay for it.
    assert (rows[2, 1].words, rows[2, 1].equal, rows[2, 1].item_from, rows[2, 1].doc_from) == (34, 30, 4, 94)
    assert rows[4, 1].words == 20 and rows[4, 1].item_from == 10
    assert decontamination.contaminated(empty, tests).count() == 0
    assert decontamination.contaminated(docs, tests.where("false")).count() == 0
    assert decontamination.contaminated(odd, tests).count() == 0


def test_decontamination_equals_brute_force_over_stretches():
    draw = random.Random(8)
    for _ in range(3000):
        n, m = draw.randint(5, 30), draw.randint(5, 40)
        test, document = np.arange(n), np.full(m, -1)
        shift, need = draw.randint(-n, m), min(12, n)
        share = draw.choice((0.1, 0.2, 0.3))
        for i in range(n):
            if 0 <= i + shift < m and draw.random() > share:
                document[i + shift] = i
        same = [0 <= i + shift < m and document[i + shift] == i for i in range(n)]
        low, high = max(0, -shift), min(n, m - shift)
        wide = [(b, e) for b in range(low, high) for e in range(b + need, high + 1)]
        expected = any(5 * sum(same[b:e]) >= 4 * (e - b) for b, e in wide)
        found = decontamination.overlap(document, test, shift, need)
        assert (found is not None) == expected
        if found:
            begin, end, equal = found
            assert (begin, end) in wide and equal == sum(same[begin:end]) and 5 * equal >= 4 * (end - begin)


def test_decontamination_finds_every_substitution_within_the_limit(spark):
    """Copies of items whose substitutions lie anywhere; one substitution more is too many."""
    draw, items, docs, expected = random.Random(9), {}, {}, set()
    for n in [*range(5, 16), 20, 23, 24, 30, 40, 60]:
        items[n] = " ".join(f"item{n}word{i}" for i in range(n))
        places = [draw.sample(range(n), n // 5) for _ in range(30)] + [range(r, n, 5)[: n // 5] for r in range(5)]
        places += [[i] for i in (0, 1, 2, 3, n - 1)] + [range(n // 5)]
        beyond = [draw.sample(range(n), n // 5 + 1) for _ in range(5)] if n <= 12 else []
        for number, gone in enumerate(places + beyond):
            words = [f"new{i}" if i in gone else w for i, w in enumerate(items[n].split())]
            docs[100 * n + number] = f"before {number} {' '.join(words)} after"
            if number < len(places):
                expected.add((100 * n + number, n))
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    tests = spark.createDataFrame(list(items.items()), "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(frame, tests).collect()} == expected


def test_decontamination_meets_a_shared_opening_once(spark):
    """300 items with one opening and 300 documents with it: rows for each, not for each pair; and every
    link follows from the passage, as brute force over all pairs finds them."""
    opening = noise(70, 15)
    items = {i: f"{opening} {noise(1000 + i, 12)}" for i in range(300)}
    docs = {i: f"{noise(5000 + i, 20)} {opening} {noise(9000 + i, 20)}" for i in range(300)}
    docs[300] = f"before it {items[7]} after it"
    docs[301] = " ".join("zzz" if i % 9 == 4 else w for i, w in enumerate(items[8].split()))
    # Too little of the opening, but enough of an item around its end.
    docs[302] = f"{noise(71, 9)} {' '.join(items[9].split()[9:])}"
    docs[303] = f"{noise(72, 9)} {' '.join(opening.split()[:9])} {noise(73, 30)}"
    items |= {900: noise(74, 20), 901: noise(74, 20)}
    docs |= {400: f"so {noise(74, 20)}", 401: noise(74, 20)}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    tests = spark.createDataFrame(list(items.items()), "item_id long, text string")
    rows = decontamination.contaminated(frame, tests).collect()
    assert len(rows) < 2 * (len(docs) + len(items))
    members = {}
    for row in rows:
        members.setdefault(row.passage, set()).add(row.item_id)
    linked = {(r.doc_id, r.item_id) for r in rows}
    linked |= {(r.doc_id, i) for r in rows if r.passage for i in members[r.passage]}
    expected = {(d, i) for d in range(302) for i in range(300)} | {(302, 9), (400, 900), (400, 901), (401, 900), (401, 901)}
    assert linked == expected
    for row in rows:
        document, test = docs[row.doc_id].split(), items[row.item_id].split()
        pairs = zip(document[row.doc_from :][: row.words], test[row.item_from :][: row.words], strict=True)
        assert sum(a == b for a, b in pairs) == row.equal >= 0.8 * row.words and row.item_words == len(test)


def test_decontamination_with_shared_passages_equals_brute_force(spark):
    """Items put together from few pieces, cut and substituted at random: repeated, nested and overlapping
    passages, items of equal text, NULL keys."""
    draw = random.Random(31)
    pieces = [noise(200 + i, n).split() for i, n in enumerate((6, 9, 12, 14, 20, 30))]

    def mixed(most: int, share: float) -> str:
        words = [w for _ in range(draw.randint(1, most)) for w in (draw.choice(pieces) if draw.random() < 0.8 else noise(draw.randint(0, 10**6), 5).split())]
        words = words[draw.randint(0, 5) : len(words) - draw.randint(0, 5)]
        return " ".join(noise(draw.randint(0, 10**6), 1, "xyz") if draw.random() < share else w for w in words)

    items = [(i, mixed(3, 0.05)) for i in range(60)]
    items += [(100 + i, items[i][1]) for i in range(5)] + [(None, items[7][1]), (None, None), (200, "")]
    docs = [(i, mixed(3, draw.choice((0.0, 0.1, 0.25)))) for i in range(80)]
    docs += [(100, docs[3][1]), (101, docs[3][1]), (None, docs[4][1]), (None, None), (5, docs[6][1])]

    def overlaps(document: str, test: str) -> bool:
        one, other = (decontamination._words([t or ""])[0] for t in (document, test))
        if len(other) < decontamination.LEAST_WORDS:
            return False
        return any(decontamination.overlap(one, other, s, min(12, len(other))) for s in range(-len(other), len(one) + 1))

    expected = {(d, i) for d, document in docs for i, test in items if overlaps(document, test)}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    rows = decontamination.contaminated(frame, tests).collect()
    members = {}
    for row in rows:
        members.setdefault(row.passage, set()).add(row.item_id)
    linked = {(r.doc_id, i) for r in rows for i in (members[r.passage] if r.passage else [r.item_id])}
    assert linked == expected and len(expected) > 300
    assert len({(r.doc_id, r.item_id, r.passage) for r in rows}) == len(rows)


def entries(spark, rows):
    return spark.createDataFrame(rows, "entry string, day string, listed boolean").selectExpr("entry", "date(day) as day", "listed")


def test_url_lists_hold_at_fetch_time(spark):
    listed = entries(spark, [
        ("bad.example.org", "2024-03-10", True), ("bad.example.org", "2024-05-01", False),
        ("bad.example.org", "2024-05-01", False), ("example.org", "2024-08-01", True), ("a.net/x", "2024-01-05", True),
        ("a.net", "2024-01-05", True), (None, "2024-01-01", True), ("b.net", None, True), ("c.net", "2024-02-02", None),
    ])
    captures = spark.createDataFrame([
        (1, "http://user@www.BAD.example.org:80/p", "2024-03-09 23:59:59"), (2, "https://bad.example.org", "2024-03-10 00:00:00"),
        (3, "https://bad.example.org/", "2024-05-01 00:00:00"), (4, "https://sub.bad.example.org/a", "2030-01-01 00:00:00"),
        (5, "https://a.net/x/y", "2024-06-01 12:00:00"), (6, "https://a.net/z", "2024-06-01 12:00:00"),
        (7, None, "2024-06-01 12:00:00"), (8, "no url", "2024-06-01 12:00:00"), (9, "https://a.net/x", None),
        (10, "https://c.net", "2024-06-01 12:00:00"), (10, "https://c.net", "2024-06-01 12:00:00"),
    ], "page_id long, url string, at string").selectExpr("page_id", "url", "cast(at as timestamp_ntz) as at")
    found = url_filter.judge(captures, listed, "page_id", "url", "at", "2024-01-01", "2024-06-01")
    assert bag(found, "page_id", "blocked", "entry") == sorted([
        (1, False, None), (2, True, "bad.example.org"), (3, False, None), (4, True, "example.org"), (5, True, "a.net/x"),
        (6, True, "a.net"), (7, False, None), (8, False, None), (9, False, None), (10, False, None), (10, False, None),
    ], key=repr)
    assert url_filter.judge(captures, listed.where("false"), "page_id", "url", "at", "2024-01-01", "2024-06-01").where("blocked").count() == 0
    assert "Python" not in found._jdf.queryExecution().toString()


def test_url_lists_meet_empty_tables_and_clashing_columns(spark):
    listed = entries(spark, [("a.net", "2024-01-05", True)])
    captures = spark.createDataFrame(
        [(1, "https://a.net/" + "x" * 2_000_000, "2024-06-01 12:00:00"), (2, "https://b.net", "2024-06-01 12:00:00"), (None, "https://a.net", None)],
        "page_id long, url string, at string",
    ).selectExpr("page_id", "url", "cast(at as timestamp_ntz) as at")
    odd = captures.selectExpr("*", *[f"7 as {n}" for n in ("entry", "host", "blocked", "valid_from", "valid_to", "month", "listed_since", "day", "listed")])
    clash = listed.selectExpr("*", *[f"8 as {n}" for n in ("page_id", "url", "at", "valid_from", "valid_to", "host", "month")])
    bounds = ("page_id", "url", "at", "2024-01-01", "2024-06-01")
    expected = [(1, True, "a.net"), (2, False, None), (None, False, None)]
    for some, entry_rows in ((captures, listed), (odd, clash)):
        found = url_filter.judge(some, entry_rows, *bounds)
        assert bag(found, "page_id", "blocked", "entry") == expected
        assert found.columns == ["page_id", "fetched", "host", "blocked", "entry", "listed_since"]
        assert url_filter.judge(some.where("false"), entry_rows, *bounds).count() == 0


def test_simhash_component_of_null_keys_only(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (3, noise(9, 40)), (None, noise(9, 40))], "doc_id long, text string")
    found = simhash.near_duplicates(docs)
    assert bag(found, "doc_id", "component") == [(3, 3), (None, 3), (None, None), (None, None)]


def labelled(spark, good, bad, label):
    texts = [(i, good(i)) for i in range(200)] + [(1000 + i, bad(i)) for i in range(200)]
    marks = [(k, 1 if k < 1000 else 0) for k, _ in texts] + [(None, 1), (5000, None), (7777, 0)]
    return spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(marks, f"doc_id long, {label} int")


def test_toxicity_finds_marked_texts(spark, odd):
    plain = lambda i: noise(i, 80)
    marked = lambda i: " ".join(w if j % 20 else "grumblefoot" for j, w in enumerate(noise(900 + i, 80).split()))
    docs, labels = labelled(spark, marked, plain, "toxic")
    model = toxicity.train(docs, labels)
    new = spark.createDataFrame([(i, plain(5000 + i), 0) for i in range(60)] + [(100 + i, marked(7000 + i), 1) for i in range(60)], "doc_id long, text string, y int")
    rows = new.select("y", toxicity.toxicity(new["text"], model).alias("score")).collect()
    assert all((r.score >= toxicity.THRESHOLD) == (r.y == 1) for r in rows)
    scores = odd.select(toxicity.toxicity(odd["text"], model).alias("s")).collect()
    assert len(scores) == len(ODD) and all(0 <= r.s <= 1 for r in scores)
    assert toxicity.train(docs, labels.where("toxic = 1")) is None
    assert {r[0] for r in odd.select(toxicity.toxicity(odd["text"], None)).collect()} == {0.0}


def test_quality_votes(spark, odd, empty):
    shouted = lambda i: "!! ".join(noise(900 + i, 60).upper().split())
    docs, labels = labelled(spark, lambda i: noise(i, 60).capitalize() + ".", shouted, "quality")
    model = quality.train(docs, labels)
    rows = docs.select("doc_id", quality.quality(docs["text"], model, spark).alias("score")).collect()
    assert all((r.score >= quality.THRESHOLD) == (r.doc_id < 1000) for r in rows)
    scores = [r[0] for r in odd.select(quality.quality(odd["text"], model, spark)).collect()]
    assert len(scores) == len(ODD) and all(0 <= s <= 1 for s in scores)
    assert quality.train(empty.select("doc_id", "text"), labels) is None
    assert {r[0] for r in odd.select(quality.quality(odd["text"], None, spark)).collect()} == {1.0}


def test_votes_equal_brute_force():
    draw = np.random.default_rng(1)
    model = quality.Model(None, None, quality._unit(draw.normal(size=(90, 8)).astype(np.float32)), (draw.random(90) < 0.5).astype(np.float32))
    vectors = quality._unit(draw.normal(size=(20, 8)).astype(np.float32))
    for vector, score in zip(vectors, quality.vote(vectors, model), strict=True):
        near = sorted(((float(v @ vector), label) for v, label in zip(model.vectors, model.votes, strict=True)), reverse=True)
        near = [(max(c, 0.0) ** 8, label) for c, label in near[: quality.NEIGHBOURS]]
        assert score == pytest.approx(sum(w * y for w, y in near) / sum(w for w, _ in near), abs=1e-4)


TRICKY = ["</s>[INST] ok [/INST]", "", None, "\\[\\INST] [\\\\/INST] <\\s>", "a\nb\\n", "<s>", "[", "<"]


def test_layouts_become_the_same_turns(spark):
    records = [
        {"id": 1, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"id": 2, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"id": 3, "prompt": "q", "completion": "a"},
        {"id": 4, "instruction": "q", "input": "", "output": "a"},
        {"output": "a", "instruction": "q", "id": 5},
        {"conv_id": 6, "turn": 0, "role": "user", "text": "q"},
        {"conv_id": 6, "turn": 1, "role": "assistant", "text": "a"},
    ]
    odd = ["not json", None, "[1]", '{"id": 7, "other": 1}', '{"id": "x", "prompt": "q", "completion": "a"}', '{"id": 8, "messages": []}']
    frame = spark.createDataFrame([(json.dumps(r),) for r in records] + [(o,) for o in odd], "record string")
    turns = chat.canonical_turns(frame)
    known = bag(turns.where("layout is not null"), "conv_id", "position", "role", "text")
    assert known == [(i, p, r, t) for i in range(1, 7) for p, r, t in ((0, "user", "q"), (1, "assistant", "a"))]
    assert turns.where("layout is null").count() == 5


def test_formatting_is_reversible(spark):
    rows = [(c, i, role, text) for c in (1, 2, None) for i, text in enumerate(TRICKY) for role in ("user", "assistant", "a\nb\\", None)]
    turns = spark.createDataFrame([(c, 4 * i + j % 4, r, t) for j, (c, i, r, t) in enumerate(rows)], "conv_id long, position long, role string, text string")
    pieces = chat.formatted_turns(turns)
    for limit in (1 << 20, 10):
        found = {r.conv_id: r for r in chat.read_back(chat.conversations(pieces, limit)).collect()}
        assert set(found) == {1, 2, None}
        own = sorted((4 * i + j % 4, r or "", t or "") for j, (c, i, r, t) in enumerate(rows) if c == 1)
        assert found[1].n_turns == len(own)
        assert found[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in own).encode()).hexdigest()
        learned = "".join(t for _, r, t in own if r == "assistant")
        assert (found[1].loss_chars, found[1].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    with session_settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        segments = chat.conversations(pieces.where("conv_id = 1"), 1 << 20)
        assert segments.count() > 1 and segments.where("whole").count() == 0
        many = chat.formatted_turns(turns.where("conv_id = 1").selectExpr("explode(sequence(1L, 40L)) AS conv_id", "position", "role", "text"))
        assert 10 < chat.conversations(many).where("whole").count() < 40
        assert {r.turns_sha256 for r in chat.read_back(chat.conversations(many)).collect()} == {found[1].turns_sha256}
        assert chat.read_back(chat.conversations(many)).count() == 40
        assert chat.read_back(segments).first().turns_sha256 == found[1].turns_sha256
    assert chat.read_back(chat.conversations(pieces.where("false"))).count() == 0
    with pytest.raises(ValueError):
        chat.read_turns("not written here")

"""Near duplicates, repeats, packing and the pipeline against brute force and planted cases."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from landfall.llm import paragraph_dedup, simhash_dedup, vector_packing
from landfall.llm.components import components
from landfall.llm.tokenizers_common import tokenizer_path

from .conftest import SF, pairs

random.seed(9)
WORDS = ["".join(random.choice("abcdefghijklmnop") for _ in range(random.randint(2, 8))) for _ in range(3000)]


def prose(n):
    return " ".join(random.choice(WORDS) for _ in range(n))


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    w = min(4, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + w]), 42) for i in range(len(words) - w + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, bits=4):
    label = list(range(len(fps)))
    find = lambda i: i if label[i] == i else find(label[i])
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    least = defaultdict(lambda: None)
    for i, x in enumerate(ids):
        r = find(i)
        least[r] = x if least[r] is None else least[r] if x is None else min(x, least[r])
    return [least[find(i)] for i in range(len(fps))]


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 180)]
    star = [(1, i) for i in range(2, 50)]
    e = spark.createDataFrame([*chain, *star, (60, 60), (200, 190), (190, 200)], "u long, v long")
    got = {r["node"]: r["label"] for r in components(e).collect()}
    assert got == {**{i: 100 for i in range(100, 181)}, **{i: 1 for i in range(1, 50)}, 190: 190, 200: 190}
    assert components(e.limit(0)).count() == 0


def test_simhash_groups_equal_brute_force(spark, docs, odd_docs):
    base = prose(60)
    near = [(10_000 + k, base.replace(base.split()[k], "changed", 1)) for k in range(25)] + [(20_000 + k, base) for k in range(20)]
    df = docs.select("doc_id", "text").union(odd_docs.select("doc_id", "text")).union(spark.createDataFrame(near, "doc_id long, text string"))
    rows = pairs(df)
    fps = [brute_fingerprint(t) for _, t in rows]
    want = sorted((str(i), f, str(c)) for (i, _), f, c in zip(rows, fps, brute_components(fps, [i for i, _ in rows])))
    got = sorted((str(r["doc_id"]), r["fp"] & (1 << 64) - 1, str(r["component_id"])) for r in simhash_dedup.simhash_groups(df).collect())
    assert got == want


def test_large_buckets_are_keyed_again_without_loss(spark):
    centre = random.getrandbits(64)
    fps = {centre}
    for _ in range(120):  # a cluster whose members share many keys
        f = centre
        for _ in range(random.randint(1, 6)):
            f ^= 1 << random.randrange(64)
        fps.add(f)
    fps |= {random.getrandbits(64) for _ in range(60)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = [tuple(r) for r in simhash_dedup.fingerprint_links(df, 4, bucket_rows=6).collect()]
    assert all(((u ^ v) & (1 << 64) - 1).bit_count() <= 4 for u, v in edges)
    joined = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = brute_components(fps, signed)
    assert [joined.get(s, s) for s in signed] == want


def test_pivot_table_loses_no_pair():
    fps = np.array([random.getrandbits(64) for _ in range(50)], dtype=np.uint64)
    near = np.array([int(f) ^ (1 << b) ^ (1 << (b * 7 % 64)) for f in fps.tolist() for b in (3, 9)], dtype=np.uint64)
    every = np.unique(np.concatenate([fps, near]))
    u, v = simhash_dedup.link_forest(every, 4)
    got = brute_components(every.tolist(), every.tolist())
    assert u.size == every.size - len(set(got))


def test_keep_one_of_each_group(spark):
    a, b = prose(80), prose(90)
    rows = [(5, a), (7, a), (2, a), (9, b), (9, b), (1, "x y z"), (None, b), (None, "alone and without an id")]
    kept = simhash_dedup.keep_one(spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, label string"))
    assert sorted(kept.collect(), key=str) == sorted([(2, a, "z"), (9, b, "z"), (1, "x y z", "z"), (None, "alone and without an id", "z")], key=str)


def test_repeated_passages_are_found_wherever_they_stand(spark):
    passages = [prose(n) for n in (51, 55, 60, 90)]
    rows, has = [], {}
    for d in range(60):
        p = passages[d % 4] if d < 40 else None
        text = prose(120 + d) + (f" {p} " if p else " ") + prose(70)
        if d % 2:
            text = text.replace(" ", "\n", 3)
        rows.append((d, text))
        has[d] = p is not None
    units = paragraph_dedup.repeated_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {u["doc_id"] for u in units} == {d for d in has if has[d]}
    assert {u["doc_id"] for u in units if not u["kept"]} >= {d for d in has if has[d] and d >= 4}
    for u in units:  # a cut near a passage's edge may hang on what stands beside it, so a component need not start in the first document
        assert u["component_id"] % 4 == u["doc_id"] % 4 and u["kept"] == (u["doc_id"] == u["component_id"])
        at = rows[u["doc_id"]][1].encode()[u["start"]:u["start"] + u["size"]]
        # A unit may reach past the passage, but what it shares with a similar one, 0.8 of its shingles or more, lies in it.
        words, passage = at.decode().split(), " ".join(passages[u["doc_id"] % 4].split())
        inside = [" ".join(words[i:i + 5]) in passage for i in range(len(words) - 4)]
        assert sum(inside) >= 0.8 * len(inside)


def test_similar_lines_are_linked(spark):
    line = prose(90).split()
    near = line[:40] + ["edited"] + line[41:]
    far = [w if k % 6 else "else" for k, w in enumerate(line)]
    rows = [(1, "\n".join([prose(40), " ".join(line)])), (2, " ".join(near) + "\n" + prose(30)), (3, " ".join(far))]
    got = [u for u in paragraph_dedup.repeated_units(spark.createDataFrame(rows, "doc_id long, text string")).collect() if u["kind"] == paragraph_dedup.LINE]
    assert sorted((u["doc_id"], u["component_id"], u["n_units"], u["kept"]) for u in got) == [(1, 1, 2, True), (2, 1, 2, False)]


def test_content_links_equal_brute_force(spark):
    """A bucket of many similar contents, compared in full, keyed again on prefixes and in blocks."""
    base = [random.getrandbits(63) for _ in range(30)]
    sets = {}
    for c in range(60):
        s = set(base[: random.choice([28, 30])])
        for _ in range(random.randint(0, 5)):
            s.discard(random.choice(base))
            s.add(random.getrandbits(63))
        sets[c] = np.array(sorted(s), dtype=np.uint64)
    df = spark.createDataFrame([(c, bytearray(s.tobytes())) for c, s in sets.items()], "content long, shingles binary")
    collided = spark.createDataFrame([(1, c) for c in sets], "key long, content long")
    label = {c: c for c in sets}
    for a in sets:
        for b in sets:
            both = len(np.intersect1d(sets[a], sets[b]))
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) and label[a] != label[b]:
                lo, hi = sorted((label[a], label[b]))
                label = {c: lo if x == hi else x for c, x in label.items()}
    for rows, size, long_set in ((1 << 14, 1 << 26, 512), (8, 1 << 26, 512), (8, 1 << 26, 10), (1 << 14, 1000, 29)):
        edges = paragraph_dedup.content_links(collided, df, rows, size, long_set)
        got = {r["node"]: r["label"] for r in components(edges).collect()}
        assert {c: got.get(c, c) for c in sets} == label


def test_hot_band_keys_lose_no_link(spark):
    """Many similar lines under the same band keys: dealt by content and keyed again, all are linked."""
    line = prose(60).split()
    rows = [(d, " ".join([*line[:d % 60], f"edit{d}", *line[d % 60 + 1:]])) for d in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    units = paragraph_dedup.find_units(df)
    hot = paragraph_dedup.hot_keys(units, df.count())
    every = lambda keys: sorted((r["key"], r["content"]) for r in paragraph_dedup.colliding(units, keys).collect())
    assert hot and every(hot) == every([])
    for rows in (paragraph_dedup.BUCKET_ROWS, 100):  # 100: the buckets count as large
        lines = [u for u in paragraph_dedup.repeated_units(df, rows).collect() if u["kind"] == paragraph_dedup.LINE]
        assert len(lines) == 150 and {u["component_id"] for u in lines} == {0}
        assert sum(u["kept"] for u in lines) == 1


def test_repeats_are_cut_once(spark, odd_docs, no_docs):
    p, q = prose(70), prose(60)
    rows = [(1, f"{prose(30)}\n{p}\n{prose(30)}"), (2, f"{p}\n{q}"), (3, q), (4, prose(100)), (None, q)]
    df = spark.createDataFrame([(i, t, len(t), "x") for i, t in rows], "doc_id long, text string, n_chars long, size string")
    got = {r["doc_id"]: r for r in paragraph_dedup.cut_repeats(df).collect()}
    assert len(got) == 5 and got[1]["text"] == rows[0][1] and got[4]["text"] == rows[3][1]
    assert got[None]["text"] == q and got[2]["text"] == "" and got[3]["text"] == ""  # NULL ids come first
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    cut = paragraph_dedup.cut_repeats(odd_docs)
    assert cut.columns == odd_docs.columns and cut.count() == odd_docs.count()
    assert paragraph_dedup.cut_repeats(no_docs).count() == 0 and paragraph_dedup.repeated_units(no_docs).count() == 0


def test_a_written_table_leaves_no_shuffle_files(spark):
    from landfall.llm import common

    before = spark.conf.get(common._FILE_CLEANUP)
    scratch = common.Scratch(spark)
    table = scratch.written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "shuffle-test")
    assert sorted(r["k"] for r in table.collect()) == list(range(7))
    assert spark.conf.get(common._FILE_CLEANUP) == before
    with pytest.raises(ZeroDivisionError), common.shuffles_removed(spark):
        assert spark.conf.get(common._FILE_CLEANUP) == "true"
        raise ZeroDivisionError
    assert spark.conf.get(common._FILE_CLEANUP) == before
    scratch.free(table)


def check_packing(rows, got, limits=(2048, 256, 2048)):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(vector_packing.VOCABULARY))
    want = defaultdict(list)
    for i, t in rows:
        want[i].append(np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(want)
    for i, own in pieces.items():
        if len(want[i]) == 1:
            ids, at = want[i][0], 0
            for r in sorted(own, key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
                assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
                at += r["length"]
            assert at == len(ids)
        else:
            assert sum(r["length"] for r in own) == sum(map(len, want[i]))
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == np.cumsum([0, *(r["length"] for r in own)])[:-1].tolist()
        n = sum(r["length"] for r in own)
        assert n & (n - 1) == 0 and n <= limits[0]  # full or a power of two: no padding
        assert len(own) <= limits[1] and sum(r["length"] - 1 for r in own) <= limits[2]


def test_packing_covers_every_id_within_all_limits(spark, docs, odd_docs):
    df = docs.select("doc_id", "text").union(odd_docs.select("doc_id", "text"))
    check_packing(pairs(df), vector_packing.pack(df.coalesce(2)).collect())
    tight = (256, 3, 200)
    small = docs.limit(40).select("doc_id", "text")
    check_packing(pairs(small), vector_packing.pack(small.coalesce(1), limits=tight).collect(), tight)


def test_loss_bearing_tokens_limit_a_sequence(spark, docs):
    """Instructions whose answers bear loss: the token and the loss limit both bind at production size."""
    limits = (2048, 256, 512)
    rows = docs.select("doc_id", "text").limit(80)
    share = F.pmod(F.col("doc_id"), F.lit(4))
    loss = F.when(share == 0, F.lit(None)).when(share == 1, F.lit(-1)).when(share == 2, F.lit(60)).otherwise(F.lit(10 ** 9))
    got = vector_packing.pack(rows.coalesce(1), limits=limits, loss=loss).collect()
    check_packing(pairs(rows), got, (2048, 256, 2048))
    bearing = {r["doc_id"]: r["doc_tokens"] if r["doc_id"] % 4 in (0, 3) else 0 if r["doc_id"] % 4 == 1 else min(60, r["doc_tokens"]) for r in got}
    held = defaultdict(int)
    for r in got:
        first = max(r["doc_tokens"] - bearing[r["doc_id"]], r["start"] + 1)
        held[r["sequence_id"]] += max(0, r["start"] + r["length"] - first)
    assert max(held.values()) <= 512 and sum(v > 400 for v in held.values()) > 3
    tokens = defaultdict(int)
    for r in got:
        tokens[r["sequence_id"]] += r["length"]
    assert any(t > 600 for t in tokens.values())  # prompts share sequences with answers


def test_dot_product_places_examples():
    p = vector_packing.Packer((8, 4, 8), opened=2)
    piece = lambda i, n: vector_packing.Piece(i, 0, bytes(4 * n), n)
    assert list(p.add(piece(0, 5))) == [] and len(p.bins) == 1
    assert list(p.add(piece(1, 6))) == [] and len(p.bins) == 2  # does not fit the first
    assert [[x.doc_id for x in s] for s in p.add(piece(2, 3))] == [[0, 2]]  # the one with room
    done = list(p.add(piece(3, 4)))
    rest = [*done, *p.finish()]
    assert sum(x.length for s in rest for x in s) == 10


def test_empty_and_null_texts_pack_their_end(spark, no_docs):
    got = vector_packing.pack(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string").coalesce(1)).collect()
    assert sorted((r["doc_id"], r["length"], r["doc_tokens"]) for r in got) == [(1, 1, 1), (2, 1, 1)]
    assert vector_packing.pack(no_docs).count() == 0


def test_pipeline_stages(spark, odd_docs):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "simhash_dedup", "paragraph_dedup", "vector_packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language_id"](spark, docs, SF)
    assert known.columns == docs.columns and known.count() >= 0.97 * len(before)
    good = stages["quality_rules"](spark, known, SF)
    kept = {r["doc_id"] for r in good.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [i for i, q in labels.items() if q == 1 and len(before[i].split()) >= 20]
    assert np.mean([i in kept for i in clean]) > 0.95
    one = stages["simhash_dedup"](spark, good, SF)
    fps = [brute_fingerprint(r["text"]) for r in one.collect()]
    assert all((a ^ b).bit_count() > 4 for k, a in enumerate(fps) for b in fps[:k])
    cut = stages["paragraph_dedup"](spark, one, SF)
    assert cut.columns == docs.columns and cut.count() == one.count()
    rows = cut.collect()
    assert all(r["n_chars"] == len(r["text"]) <= len(before[r["doc_id"]]) for r in rows)
    check_packing([(r["doc_id"], r["text"]) for r in rows], stages["vector_packing"](spark, cut, SF).collect())
    assert stages["simhash_dedup"](spark, stages["quality_rules"](spark, odd_docs, SF), SF).columns == odd_docs.columns


def test_pipeline_runs_whole(spark):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(got.columns)
    assert got.count() > 0


def left_of_passages(spark, copies, passages):
    """Share of the words of each second copy that its text still has after the cut; the copies stand in lines of their own surroundings."""
    rows = []
    for d, (first, second) in enumerate(copies):
        for k, p in ((0, first), (1000, second)):
            rows.append((d + k, f"{prose(40)} {p} {prose(40)}"))
    got = {r["doc_id"]: r["text"] for r in paragraph_dedup.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[d] == rows[2 * d][1] for d in range(len(copies)))  # the first copies stay whole
    around = [len(got[1000 + d].split()) - 80 for d in range(len(copies))]
    assert min(around) >= 0  # what is not shared stays
    return [max(0, n) / len(p.split()) for n, p in zip(around, passages)]


def test_removed_span_is_the_whole_passage(spark):
    exact = [prose(n) for n in range(51, 151, 5)]
    assert left_of_passages(spark, [(p, p) for p in exact], exact) == [0.0] * len(exact)


def shingles(text):
    words = text.lower().split()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def test_unique_text_stays(spark):
    """A line and the block around it are no copies of each other, whatever the line breaks."""
    rows = [(d, (f"{prose(3)}\n{prose(100)}", f"{prose(4)}\n\n{prose(90)}\n{prose(6)}", f"{prose(60)}\n{prose(5)}\n{prose(50)}\n\n{prose(7)}")[d % 3]) for d in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert paragraph_dedup.repeated_units(df).count() == 0
    assert {r["doc_id"]: r["text"] for r in paragraph_dedup.cut_repeats(df).collect()} == dict(rows)


def test_shared_lines_stay_once_and_unique_neighbours_whole(spark):
    """Shared lines between unique lines, with blank lines and with single line breaks."""
    shared = [prose(random.randint(12, 70)) for _ in range(30)]
    rows, unique = [], {}
    for d in range(120):
        mine = [prose(random.randint(8, 30)) for _ in range(3)]
        a, b = random.sample(shared, 2)
        rows.append((d, ("\n\n" if d % 2 else "\n").join([mine[0], a, mine[1], b, mine[2]])))
        unique[d] = mine
    got = {r["doc_id"]: r["text"] for r in paragraph_dedup.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, mine in unique.items():
        assert all(x in got[d] for x in mine), d
    texts = " | ".join(got.values())
    used = [x for x in shared if any(x in t for _, t in rows)]
    assert all(texts.count(x) == 1 for x in used)


def test_a_neighbour_line_keeps_a_word_that_is_alike_by_chance(spark):
    """Unique lines beside a shared one that begin or end with the same few words; a short line that is the same goes whole."""
    shared, other = prose(40), prose(40)
    for gap in ("\n", "\n\n"):
        rows = [(d, gap.join([f"{prose(12)} same end", shared, f"same three words {prose(12)}"])) for d in range(3)]
        rows += [(d, gap.join([prose(12), "short line", other, prose(12)])) for d in (3, 4)]
        got = {r["doc_id"]: r["text"] for r in paragraph_dedup.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        for d, t in rows[:3]:
            first, _, last = t.split(gap)
            assert first in got[d] and last in got[d] and (shared in got[d]) == (d == 0)
        assert "short line" in got[3] and "short line" not in got[4]


def test_band_rows_of_a_part_are_those_of_its_keys():
    """Packed rows of several tasks, with hot keys dealt by content and a part so large that keys go out before its end."""
    pa = paragraph_dedup.pa
    rng = np.random.default_rng(11)
    tasks = [(rng.integers(0, 300, n), rng.integers(0, 50, n)) for n in (900, 700, 800)]
    tasks = [(np.append(k, np.full(120, 7)), np.append(c, np.arange(120))) for k, c in tasks]
    rows = {(int(k), int(c)) for t in tasks for k, c in zip(*t)}
    for hot, most, held in (([], 1 << 14, 1 << 20), ([5, 7], 1 << 14, 1 << 20), ([5], 40, 1 << 20), ([5], 40, 60)):
        batches = []
        for k, c in tasks:
            part, packed = paragraph_dedup._packed([(k, c, 4 + c % 3)], 16)
            b = [pa.RecordBatch.from_arrays([part, packed], ["part", "rows"])]
            batches += paragraph_dedup._dealt_anew(hot)(b) if hot else b
        table = pa.Table.from_batches(batches).sort_by("part")
        before, paragraph_dedup.HELD_ROWS = paragraph_dedup.HELD_ROWS, held
        try:
            got = [tuple(r.values()) for b in paragraph_dedup._part_buckets(hot, most, False)(table.to_batches(max_chunksize=5)) for r in b.to_pylist()]
        finally:
            paragraph_dedup.HELD_ROWS = before
        want = set()
        for k in {k for k, _ in rows}:
            own = {c for x, c in rows if x == k}
            if k in hot or len(own) > 1:
                want |= {(k, c, 4 + c % 3, k in hot, k not in hot and len(own) > most) for c in own}
        assert set(got) == want
        assert len(got) == len(want) or held == 60


def test_units_count_their_different_shingles():
    """Against sets, in texts with many repeats, and without a search of all shingles among the repeated ones."""
    rng = np.random.default_rng(12)
    texts = [" ".join(f"w{w}" + ("\n" * int(rng.integers(0, 3)) if rng.integers(9) == 0 else "") for w in rng.integers(0, int(rng.integers(2, 9)), 80)).encode() for _ in range(30)]
    u = paragraph_dedup.Units(texts)
    distinct = u.bands()[2]
    for k in range(u.first.size):
        own = texts[u.text[k]][u.start[k]:u.start[k] + u.size[k]].decode()
        assert distinct[k] == len(shingles(own))


def test_every_shingle_of_copies_stands_somewhere(spark, docs):
    """Copies cut at other places: no five words in a row within a line are lost."""
    lines = [prose(random.randint(5, 40)) for _ in range(200)]
    rows = []
    for d in range(80):
        at = random.randrange(len(lines) - 12)
        rows.append((d, "".join(x + random.choice(["\n", "\n\n"]) for x in lines[at:at + random.randint(1, 12)])))
    rows += [(1000 + r["doc_id"], r["text"]) for r in docs.filter("text is not null").limit(120).collect() for _ in range(2)]
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    got = paragraph_dedup.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    stand = set().union(*(shingles(r["text"]) for r in got))
    lost = {s for _, t in rows[:80] for x in t.split("\n") for s in shingles(x)} - stand
    assert not lost


def test_repeated_units_equal_all_pairs(spark):
    """Lines and blocks against an all-pairs comparison of their shingle sets."""
    base = [prose(random.randint(20, 60)).split() for _ in range(12)]
    rows = []
    for d in range(40):
        text = []
        for _ in range(random.randint(1, 4)):
            w = list(random.choice(base))
            for _ in range(random.choice([0, 0, 1])):
                w[random.randrange(len(w))] = f"w{random.randrange(10 ** 6)}"
            text.append(" ".join(w) + random.choice(["\n", "\n\n"]))
        rows.append((d, "".join(text)))
    found = []
    for d, t in rows:
        at = 0
        for block in t.split("\n\n"):
            own, inside = [x for x in block.split("\n") if x], at
            for x in block.split("\n"):
                if len(x.split()) >= 5:
                    found.append((d, inside, len(x), shingles(x)))
                inside += len(x) + 1
            if len(own) > 1:
                found.append((d, at, len("\n".join(own)), shingles(block)))
            at += len(block) + 2
    label = list(range(len(found)))
    for i, a in enumerate(found):
        for j, b in enumerate(found[:i]):
            if len(a[3] & b[3]) >= 0.8 * len(a[3] | b[3]):
                lo, hi = sorted((label[i], label[j]))
                label = [lo if x == hi else x for x in label]
    groups = defaultdict(list)
    for k, x in enumerate(label):
        groups[x].append(found[k][:3])
    want = set()
    for own in groups.values():
        d, s, n = min(own)
        others = [x for x in own if x[0] != d or x[1] >= s + n or x[1] + x[2] <= s]
        if others:
            want |= {(d, s, d, len(others) + 1, True)} | {(x[0], x[1], d, len(others) + 1, False) for x in others}
    got = {(u["doc_id"], u["component_id"], u["n_units"], u["kept"]) for u in
           paragraph_dedup.repeated_units(spark.createDataFrame(rows, "doc_id long, text string")).collect() if u["kind"] != paragraph_dedup.PIECE}
    assert len(want) > 40 and got == {(d, c, n, k) for d, _, c, n, k in want}


def changed(p, n):
    """``p`` with ``n`` words changed, evenly spread."""
    words = p.split()
    for k in range(n):
        words[(2 * k + 1) * len(words) // (2 * n)] = f"changed{k}"
    return " ".join(words)


def test_near_copies_that_are_not_lines_are_removed(spark):
    for size, n in ((60, 1), (100, 2), (200, 4)):
        ps = [prose(size) for _ in range(25)]
        left = left_of_passages(spark, [(p, changed(p, n)) for p in ps], ps)
        print(size, n, np.mean(left), max(left), sum(x >= 0.5 for x in left))
        assert np.mean(left) <= 0.15
    wrapped = lambda p, n: "\n".join(" ".join(p.split()[k:k + n]) for k in range(0, len(p.split()), n))
    p = prose(60)
    rows = [(1, f"{prose(30)}\n\n{wrapped(p, 12)}\n \n{prose(30)}"), (2, f"{prose(30)}\n\n{wrapped(changed(p, 1), 9)}\n\n{prose(30)}"), (3, f"{p}\n{prose(30)}")]
    got = [u for u in paragraph_dedup.repeated_units(spark.createDataFrame(rows, "doc_id long, text string")).collect() if u["kind"] != paragraph_dedup.PIECE]
    assert sorted((u["doc_id"], u["component_id"], u["n_units"], u["kept"]) for u in got) == [(1, 1, 3, True), (2, 1, 3, False), (3, 1, 3, False)]


def test_short_lines_are_compared(spark):
    lines = [prose(n) for n in (5, 8, 12, 15, 19)]
    near = " ".join([*lines[4].split()[:18], "other"])  # 14 of 16 shingles are shared
    rows = [(d, "\n".join(f"{prose(25)}\n{x}" for x in (*lines, "four words stay here"))) for d in range(3)] + [(3, f"{prose(25)}\n{near}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"].split("\n") for r in paragraph_dedup.cut_repeats(df).collect()}
    assert got[0] == rows[0][1].split("\n")
    for d in (1, 2):
        assert not set(lines) & set(got[d]) and "four words stay here" in got[d] and len(got[d]) == 7
    assert near not in got[3] and got[3][0] == rows[3][1].split("\n")[0]


def test_sets_and_pairs_made_at_once_are_those_made_one_by_one():
    rng = np.random.default_rng(5)
    units = [" ".join(f"W{w}" for w in rng.integers(0, 40, n)) for n in rng.integers(5, 60, 40)]
    units += [u + " tail" for u in units[:20]] + ["a b\nc\n\nd e", "A B C D E", "x " * 30, "é è ç à ù " * 3]
    together = paragraph_dedup.sets_of([u.encode() for u in units])
    assert together == [paragraph_dedup.sets_of([u.encode()])[0] for u in units]
    sets = [np.frombuffer(s, dtype=np.uint64) for s in together]
    for u, s in zip(units, sets):
        words = u.lower().split()
        assert s.size == len({tuple(words[k:k + 5]) for k in range(len(words) - 4)}) and (s[1:] > s[:-1]).all()
    linked = 0
    for i in range(len(sets)):
        for j in range(i):
            pair = paragraph_dedup.similar_pair([i, j], [sets[i], sets[j]])
            both = len(set(sets[i].tolist()) & set(sets[j].tolist()))
            assert bool(pair[0]) == (both >= 0.8 * (sets[i].size + sets[j].size - both) - 1e-9)
            assert pair == paragraph_dedup.similar_forest(np.array([i, j]), [sets[i], sets[j]])
            linked += len(pair[0])
    assert linked


def joined(contents, us, vs):
    label = {int(c): int(c) for c in contents}
    for u, v in zip(us, vs):
        lo, hi = sorted((label[u], label[v]))
        label = {c: lo if x == hi else x for c, x in label.items()}
    return label


def test_indexed_and_paired_links_are_those_of_all_pairs():
    rng = np.random.default_rng(7)
    for _ in range(40):
        n = int(rng.integers(2, 70))
        base = [rng.integers(0, 2 ** 62, 30, dtype=np.uint64) for _ in range(3)]
        sets = [np.unique(np.concatenate([base[rng.integers(3)][:rng.integers(1, 30)], rng.integers(0, 2 ** 62, rng.integers(0, 4), dtype=np.uint64)])) for _ in range(n)]
        near = [(a, b) for a in range(n) for b in range(a) if (x := np.intersect1d(sets[a], sets[b]).size) >= 0.8 * (sets[a].size + sets[b].size - x) - 1e-9]
        want = joined(range(n), *(zip(*near) if near else ((), ())))
        for indexed in (1, n):
            assert joined(range(n), *paragraph_dedup.similar_forest(np.arange(n), sets, indexed)) == want
        pairs = paragraph_dedup.similar_pairs([*range(n), n, n + 1], [x.tobytes() for x in (*sets, sets[0], sets[0])], [n, 2])
        assert sorted(map(sorted, zip(*pairs))) == sorted([sorted(x) for x in near] + [[n, n + 1]])


def test_a_bucket_of_unlike_contents_is_not_compared_pair_by_pair(monkeypatch):
    """Many contents that share a shingle and little else, as under a band key of a common passage."""
    rng = np.random.default_rng(8)
    sets = [np.append(np.uint64(1), np.sort(rng.integers(2, 2 ** 62, 9, dtype=np.uint64))) for _ in range(2000)]
    sets.append(sets[0].copy())
    compared = []
    spy = type(np)("spy")
    spy.__dict__.update(vars(np))
    spy.searchsorted = lambda a, v, *x, **y: (compared.append(np.size(v)), np.searchsorted(a, v, *x, **y))[1]
    monkeypatch.setattr(paragraph_dedup, "np", spy)
    assert joined([0, 2000], *paragraph_dedup.similar_forest(np.arange(2001), sets)) == {0: 0, 2000: 0}
    assert sum(compared) < 20 * sum(x.size for x in sets)


def test_buckets_across_batches_are_whole():
    import pyarrow as pa

    rng = np.random.default_rng(9)
    for most, fitting in ((4, True), (4, False), (100, True)):
        key = np.sort(np.concatenate([rng.integers(0, 60, 300), np.full(150, 7), np.full(90, 8)]))
        content = rng.integers(0, 40, key.size)
        rows = list(zip(key.tolist(), content.tolist(), (3 + content % 13).tolist()))
        batches = [pa.RecordBatch.from_arrays([pa.array(key[k:k + 11]), pa.array(content[k:k + 11]), pa.array((3 + content[k:k + 11] % 13).astype(np.int32))], ["a", "b", "c"]) for k in range(0, key.size, 11)]
        got = [tuple(r.values()) for b in paragraph_dedup._buckets([8, 3], most, fitting)(batches) for r in b.to_pylist()]
        want = set()
        for k in set(key.tolist()):
            own = sorted({x[1:] for x in rows if x[0] == k})
            over = k not in (3, 8) and len(own) > most
            for c, n in own:
                fits = any(d != c and 5 * min(m, n) >= 4 * max(m, n) for d, m in own)
                if k in (3, 8) or over or (fits if fitting else len(own) > 1):
                    want.add((k, c, n, k in (3, 8), over))
        assert set(got) == want and len({x[4] for x in want}) == (2 if most == 4 else 1)
        once = [x for x in got if not x[4] and x[0] not in (3, 8)]
        assert len(once) == len(set(once))


def test_widths_of_one_round_grow_as_rounds_do():
    rng = np.random.default_rng(10)
    words = [f"w{k}" for k in rng.integers(0, 10 ** 6, 400)]
    kept, own = ["x"] * 9 + words, ["y"] * 3 + [w if k % 97 else f"c{k}" for k, w in enumerate(words)]
    _, h, _, _ = next(paragraph_dedup._texts([paragraph_dedup.pa.RecordBatch.from_arrays([paragraph_dedup.pa.array([" ".join(kept).encode()])], ["t"])]))
    h = (h >> np.uint64(32)).astype(np.uint32)

    def ask(r, widths):
        n, (x, y) = sum(widths), (r["r_begin"], r["r_end"])
        r = {**r, "context0": h[max(0, x - n):x][::-1].tobytes(), "context1": h[y:y + n].tobytes(), "inner": None}
        pa = paragraph_dedup.pa
        b = pa.RecordBatch.from_arrays([pa.array([" ".join(own).encode()]), pa.array([1]), pa.array([2]), pa.array([[r, r]])], ["text", "i", "k", "rows"])
        return [x for out in paragraph_dedup._grown(widths)([b]) for x in out.to_pylist()]

    r = {"begin": 203, "end": 213, "r_id": 3, "r_key": 4, "r_begin": 209, "r_end": 219, "shared": 6, "whole": 6, "more0": True, "more1": True, "ends": False, "least": 0, "units": [8]}
    one = ask(r, [8])[0]
    assert one["more0"] or one["more1"]
    two = ask(one, [64])[0]
    assert two["end"] - two["begin"] > 100
    three = ask(two, [512])[0] if two["more0"] or two["more1"] else two
    assert ask(r, [8, 64, 512]) == [three] and (three["begin"], three["end"]) == (4, 403)

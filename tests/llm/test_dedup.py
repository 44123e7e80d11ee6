"""Line dedup, exact dedup, n-gram join, decontamination against brute force."""

import random
from collections import Counter

import pytest

from pyspark.sql import functions as F

from saleslens.llm import bloom, queries, queries_sql
from saleslens.llm.components import components
from saleslens.llm.decontaminate import build_index, decontaminate, phrase_matches, proximity_matches, words
from saleslens.llm.exact_dedup import exact_dedup, keep_one
from saleslens.llm.line_dedup import line_dedup
from saleslens.llm.ngram_join import _Join, first_grams, fragment_names, gram_set, keep_representatives, ngram_join, size_classes, _WordHashes, _differ, _fold, sketch
from tests.llm.helpers import LOWER, SF, WS, docs_frame, duck, linked_components, rows_of, sha, squeeze


@pytest.mark.parametrize("name", ["op1_line_dedup", "op5_mix_sources", "op6_decontaminate", "op8_exact_dedup", "op9_ngram_join"])
def test_query_matches_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = duck(queries_sql.ORACLE_SQL[name])[list(got.columns)]
    order = list(got.columns)
    got, want = (d.astype(str).sort_values(order).reset_index(drop=True) for d in (got, want))
    assert got.equals(want)


LINE = "A line that is long enough to count"
EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "tiny"), (5, LINE), (6, f" {LINE.upper()}\t\n{LINE}"), (7, f"x\n{LINE}\ny"),
        (8, f"x\n{LINE}\ny"), (9, "é" * 19 + "\n" + "é" * 20), (10, "é" * 20), (11, "É" * 20), (12, "é" * 20), (13, "w " * 60_000),
        (14, "AB c"), (15, "ab C"), (16, "A\tB c "), (None, f"{LINE}\nnull id"), (7, f"x\n{LINE}\ny")]


def brute_lines(rows, least=20, docs=3):
    def key(line):
        return line.strip(WS).translate(LOWER)

    held = {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= least:
                held.setdefault(k, []).append(i)
    keep = {k: max((i for i in v if i is not None), default=None) for k, v in held.items() if len(v) >= docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if key(x) not in keep or keep[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_bits", [bloom.MAX_BITS, bloom.SHARD_BITS])
def test_line_dedup_edges(spark, max_bits):
    got = line_dedup(docs_frame(spark, EDGE), max_bits=max_bits)
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept_text") == brute_lines(EDGE)


def test_bloom_saturated_filter_keeps_results(spark):
    import numpy as np
    filt = np.full(bloom.SHARD_BITS // 8, 255, np.uint8)  # suspects everything
    at = bloom.probes(np.arange(10, dtype=np.uint64), bloom.SHARD_BITS)
    assert bloom.holds(filt, at).all() and not bloom.holds(np.zeros_like(filt), at).any()


def brute_exact(rows):
    groups = {}
    for at, (i, t) in enumerate(rows):
        groups.setdefault(squeeze(t), []).append((len(t or ""), -i if i is not None else float("-inf"), -at, i))
    out = []
    for norm, members in groups.items():
        best = max(members)
        out += [(m[3], best[3], len(members), m == best, sha(norm)) for m in members]
    return sorted(out, key=repr)


@pytest.mark.parametrize("size,bits", [(1024, 64), (2, 64), (3, 2), (1, 1)])
def test_exact_dedup_edges(spark, size, bits):
    rows = [r for r in EDGE if size > 100 or len(r[1] or "") < 1000] + [(20, "abababab"), (21, "abab abab"), (22, "ababababa")]
    got = exact_dedup(docs_frame(spark, rows), size, bits)
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_exact(rows)


def test_keep_one_drops_repeated_rows(spark):
    docs = docs_frame(spark, EDGE)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == sorted(r[0] for r in brute_exact(EDGE) if r[3] and r[0])


REPEATED = [(1, "a b c d e f g h i j k"), (1, "a b c d e f g h i j  k "), (1, "a b c d e f g h i j   k"), (1, "a b c d e f g h i j   k"),
            (2, "abcdefghijk" + " " * 9), (3, "zz"), (3, "yy"), (None, "no id"), (None, "no id"), (None, "no  id"), (4, None), (4, ""), (4, None)]


def test_keep_one_of_texts_under_one_id(spark):
    """The longest original stays, whatever shares its id; one of rows that repeat it."""
    kept = keep_one(docs_frame(spark, REPEATED)).collect()
    groups = {}
    for i, t in REPEATED:
        groups.setdefault(squeeze(t), []).append((-len(t or ""), i is None, i or 0, t))
    want = [min(v, key=lambda m: m[:3]) for v in groups.values()]
    assert sorted(((r.doc_id, len(r.text or "")) for r in kept), key=repr) == sorted(((None if n else i, -size) for size, n, i, _ in want), key=repr)


def test_exact_dedup_of_text_ids(spark):
    rows = spark.createDataFrame([("b", "x y"), ("a", "xy"), ("c", "x y"), (None, "x y"), ("d", "z")], "doc_id string, text string")
    assert rows_of(exact_dedup(rows), "doc_id", "keep_id", "kept") == sorted(
        [("b", "b", True), ("a", "b", False), ("c", "b", False), (None, "b", False), ("d", "d", True)], key=repr)
    assert sorted(r.doc_id for r in keep_one(rows).collect()) == ["b", "d"]


def test_one_row_of_each_component_stays(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long), (1, long + " end"), (1, long), (2, long + " more"), (None, "alone " + long.upper().replace("W", "q")),
            (None, "alone " + long.upper().replace("W", "q") + " x"), (7, "few words"), (7, "few words"), (8, None), (8, None)]
    kept = keep_representatives(docs_frame(spark, rows), 5, (80, 100)).collect()
    assert sorted((repr(r.doc_id) for r in kept)) == sorted(["1", "None", "7", "8", "8"])


def near_copies(seed, groups, size, words_each):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, at = [], 0
    for _ in range(groups):
        base = [draw.choice(vocabulary) for _ in range(draw.randint(1, words_each))]
        for _ in range(draw.randint(1, size)):
            own = list(base)
            for _ in range(draw.randint(0, 3)):
                own[draw.randrange(len(own))] = draw.choice(vocabulary)
            rows.append((at, " ".join(own)))
            at += 1
    return rows


@pytest.mark.parametrize("gram,similarity,tile,few", [(3, (90, 100), 2000, 500_000), (3, (90, 100), 2, 0), (5, (80, 100), 3, 0)])
def test_ngram_join_against_all_pairs(spark, gram, similarity, tile, few):
    rows = near_copies(7, 25, 8, 120) + [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "One"), (905, "one two"), (906, "two one")]
    want = linked_components(rows, gram, *similarity)
    got = ngram_join(docs_frame(spark, rows), gram, similarity, tile, few)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want


def templates(seed, count, own_words, pairs):
    """Texts of one template; the first ``pairs`` have a twin that links with them."""
    draw, rows = random.Random(seed), []
    shared = [f"t{i}" for i in range(90)]
    for i in range(count):
        own = [f"o{draw.randrange(10**9)}" for _ in range(own_words)]
        rows.append((i, " ".join(shared + own)))
        if i < pairs:
            rows.append((10_000 + i, " ".join(shared + own[:-1] + ["twin"])))
    return rows


@pytest.mark.parametrize("own_words", [3, 5, 8, 12])
def test_ngram_join_of_templates(spark, own_words):
    rows = templates(own_words, 90, own_words, 25) + near_copies(9, 3, 8, 120)
    rows = [(at, text) for at, (_, text) in enumerate(rows)]
    want = linked_components(rows, 3, 90, 100)
    got = ngram_join(docs_frame(spark, rows), 3, (90, 100), tile=4, broadcast_rows=0)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want


def test_template_texts_do_not_all_meet(spark):
    met = []

    class Watched(_Join):
        def cut_roles(self, inside, sets):
            roles = super().cut_roles(inside, sets)
            met.append((inside.count(), roles.where("left").count()))
            return roles

    rows = templates(1, 400, 12, 10)
    got = {r.doc_id: r.component_id for r in Watched(docs_frame(spark, rows), 3, (90, 100), 20, 500_000, 1 << 31).run().collect()}
    assert got == {i: i % 10_000 for i, _ in rows}
    # the large groups hold many members, of whom none meet: twins are linked by their own leader
    assert met[0][0] > 400 and met[0][1] == 0


def test_near_copies_with_own_words_do_not_meet(spark):
    draw, roles, tiled = random.Random(5), [], []

    class Watched(_Join):
        def cut_roles(self, inside, sets):
            found = super().cut_roles(inside, sets)
            roles.append((inside.count(), found.where("left").count()))
            return found

        def tiled(self, members, sets, own):
            found = super().tiled(members, sets, own)
            if own is not None:
                tiled.append((members.count(), found.count()))
            return found

    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(300):  # six words of its own: too many to link, too few to hide the fragments
        own = list(base)
        for at in draw.sample(range(100), 6):
            own[at] = f"o{draw.randrange(10**9)}"
        rows.append((i, " ".join(own)))
    rows += [(300 + at, text) for at, text in near_copies(9, 6, 8, 120)]
    want = linked_components(rows, 5, 80, 100)
    got = Watched(docs_frame(spark, rows), 5, (80, 100), 250, 500_000, 1 << 31).run()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want
    assert roles[0][0] > 250 and roles[0][1] < 300  # no gram of the base is among the first ones of most
    assert tiled[0][0] >= tiled[0][1] > 0  # a member stands once in a tile


@pytest.mark.parametrize("tile", [4, 1000])
def test_one_group_of_all_finds_every_link(spark, tile):
    rows = [(at, text) for at, (_, text) in enumerate(templates(4, 40, 4, 15) + near_copies(3, 8, 6, 120))]
    join = _Join(docs_frame(spark, rows), 3, (90, 100), tile, 0, 1 << 31)
    least = join.classes.agg(F.min("cid").alias("leader"))
    members = join.classes.select("cid").join(F.broadcast(least)).select("leader", "cid")
    sets = join.sets(members)
    nothing = spark.createDataFrame([], "node bigint, component bigint")
    found = join.links(join.across(members, nothing, sets), sets)
    ids = {r.cid: r.first_id for r in join.classes.collect()}
    hashes = _WordHashes()
    grams = {i: set(gram_set(dict(rows)[i], hashes, 3).tolist()) for i in ids.values()}
    want = {(a, b) for a in grams for b in grams if a < b and 100 * len(grams[a] & grams[b]) >= 90 * len(grams[a] | grams[b])}
    assert len(want) >= 15 and {tuple(sorted((ids[r.u], ids[r.v]))) for r in found.collect()} == want


@pytest.mark.parametrize("num,den", [(90, 100), (80, 100), (1, 1), (1, 2)])
def test_linked_sets_share_a_first_gram_in_any_order(num, den):
    draw, linked = random.Random(num), 0
    for _ in range(3000):
        universe = list(range(draw.randint(1, 60)))
        draw.shuffle(universe)
        a = [x for x in universe if draw.random() < 0.93]
        b = [x for x in a if draw.random() < 0.95] + [x for x in universe if x not in a and draw.random() < 0.1]
        b = [x for x in universe if x in b]
        a, b = sorted((a, b), key=len)
        if a and den * len(set(a) & set(b)) >= num * len(set(a) | set(b)):
            linked += 1
            assert set(a[:first_grams(len(a), num, den)[0]]) & set(b[:first_grams(len(b), num, den)[1]])
    assert linked > 100


def test_ngram_join_repeated_and_null_ids(spark):
    text = "a b c d e f g h i j k l"
    got = ngram_join(docs_frame(spark, [(3, text), (3, text), (None, text), (5, text + " m n o p q r s"), (9, None)]))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == sorted(
        [(3, 10, 3), (3, 10, 3), (None, 10, 3), (5, 17, 5), (9, 0, 9)], key=repr)


def test_no_linked_pair_misses_a_fragment():
    draw, hashes = random.Random(3), _WordHashes()
    for num, den in ((90, 100), (80, 100)):
        classes = size_classes(num, den)
        for _ in range(150):
            base = [str(draw.randrange(10_000)) for _ in range(draw.randint(3, 400))]
            other = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 40))):
                other[draw.randrange(len(other))] = "x" + str(draw.randrange(10_000))
            a, b = (gram_set(" ".join(w), hashes, 3) for w in (base, other))
            shared = len(set(a.tolist()) & set(b.tolist()))
            x, y = sketch(a), sketch(b)
            size = min(len(x), len(y))
            assert _differ(_fold(x, size), _fold(y, size)) <= len(a) + len(b) - 2 * shared
            if den * shared >= num * (len(a) + len(b) - shared):
                assert set(fragment_names(a, classes).tolist()) & set(fragment_names(b, classes).tolist())


def test_keep_representatives(spark):
    rows = near_copies(5, 6, 5, 60)
    want = linked_components(rows, 5, 80, 100)
    kept = keep_representatives(docs_frame(spark, rows), 5, (80, 100))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (1, 0)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


ITEMS = [(1, "the quick brown Fox jumps over the lazy dog and runs away"), (2, "two words"), (3, None), (4, "!!"), (2, "two words"), (None, "null id here")]


def brute_leaks(rows, items, width=10):
    out = []
    for i, t in rows:
        own, hit, ids = words(t), set(), set()
        for item, text in items:
            w = words(text)
            n = min(width, len(w))
            for k in range(len(w) - n + 1 if n else 0):
                for at in range(len(own) - n + 1):
                    if own[at:at + n] == w[k:k + n]:
                        hit.update(range(at, at + n))
                        if item is not None:
                            ids.add(str(item))
        out.append((i, len(own), len(hit), sorted(ids)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard,block", [(2_000_000, 4_000_000), (5, 10)])
def test_decontaminate_edges(spark, shard, block):
    rows = [(1, "So THE quick-brown fox, jumps over the lazy dog and runs away!"), (2, "quick brown fox jumps over the lazy dog and runs away"),
            (3, None), (4, ""), (5, "two Words two words"), (6, "two"), (7, "words"), (8, "null id here"), (9, "two x words"), (5, "again two words"),
            (None, "two words"), (10, "z " * 30_000 + "two words")]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate(docs_frame(spark, rows), items, shard_words=shard, block_chars=block)
    assert rows_of(got, "doc_id", "n_words", "n_hit", "item_ids") == brute_leaks(rows, ITEMS)


def test_proximity_matches(spark):
    docs = docs_frame(spark, [(1, "alpha filler beta filler gamma"), (2, "gamma beta alpha"), (3, "alpha " + "far " * 40 + "beta gamma")])
    items = spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string")
    index = build_index(docs)
    near = proximity_matches(index, items, slop=4, n_terms=3)
    assert sorted({r.doc_id for r in near.collect()}) == [1, 2]
    assert rows_of(phrase_matches(index, items), "doc_id") == []


def test_a_neighbouring_document_hides_no_match(spark):
    # the nearest "beta" of the second document's "alpha" stands in the first
    docs = docs_frame(spark, [(1, "far away beta"), (2, "alpha one two three beta"), (3, "beta"), (4, "alpha " + "x " * 5 + "beta")]).coalesce(1)
    items = spark.createDataFrame([(7, "alpha beta")], "item_id long, text string")
    found = proximity_matches(build_index(docs), items, slop=4, n_terms=2)
    assert rows_of(found, "doc_id", "start", "n_words") == [(2, 0, 5)]


def brute_near(rows, items, slop, n_terms):
    texts = [(i, words(t)) for i, t in rows]
    counts = Counter(w for _, own in texts for w in own)
    out = []
    for i, own in texts:
        ids = set()
        for item, text in items:
            terms = sorted(set(words(text)), key=lambda w: (counts[w], w))[:n_terms]
            for at, w in enumerate(own):
                if terms and w == terms[0] and set(terms) <= set(own[max(0, at - slop):at + slop + 1]) and item is not None:
                    ids.add(str(item))
        out.append((i, sorted(ids)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard,block", [(2_000_000, 4_000_000), (40, 60)])
def test_proximity_against_brute_force(spark, shard, block):
    draw = random.Random(11)
    vocabulary = [f"v{i}" for i in range(40)] + [f"common{i}" for i in range(3)] * 8
    rows = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 60)))) for i in range(120)] + [(5, None), (5, "V1 v2"), (None, "v1 v2 v3")]
    items = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 12)))) for i in range(40)]
    items += [(40, "v1 absent v2"), (41, None), (42, ""), (None, "v1 v2"), (3, "v4 v5"), (43, "v6 v6")]
    got = decontaminate(docs_frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), 10, shard, block, slop=6, n_terms=3)
    want = brute_near(rows, items, 6, 3)
    assert rows_of(got, "doc_id", "near_ids") == want and sum(len(x) for _, x in want) > 100
    assert rows_of(got, "doc_id", "n_words", "n_hit", "item_ids") == brute_leaks(rows, items)


@pytest.mark.parametrize("run", [
    lambda s, d: line_dedup(d), lambda s, d: exact_dedup(d), lambda s, d: ngram_join(d), lambda s, d: keep_one(d),
    lambda s, d: decontaminate(d, s.createDataFrame([], "item_id long, text string"))])
def test_empty_tables(spark, run):
    assert run(spark, docs_frame(spark, [])).count() == 0


def test_no_items(spark):
    got = decontaminate(docs_frame(spark, [(1, "a b")]), spark.createDataFrame([], "item_id long, text string"))
    assert rows_of(got, "doc_id", "n_words", "n_hit", "item_ids") == [(1, 2, 0, [])]

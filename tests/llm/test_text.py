"""Text operators against libraries and brute-force versions."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import language, licenses, mixing, quality, queries, sharding, simhash, spm_codec, token_files
from tessera.llm.common import Memo, runs


# ---- helpers -----------------------------------------------------------

def test_runs_cover_all_rows_in_order():
    sizes = [1, 5, 100, 2, 2, 2]
    assert list(runs(sizes, 6)) == [(0, 2), (2, 3), (3, 6)]
    assert list(runs([], 6)) == []
    assert list(runs([0, 0], 6)) == [(0, 2)]


def test_memo_stays_bounded_and_right():
    made = []
    memo = Memo(lambda k: made.append(k) or k * 2, 10)
    for i in range(100):
        memo.turn()
        assert memo[i % 30] == i % 30 * 2
        assert len(memo) <= 10 and len(memo.old) <= 10


# ---- 1: mixing ---------------------------------------------------------

def test_rates_match_projected_gradient_by_arrays(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.4, 0.4, 0.4], 200)
    tokens = rng.integers(1, 500, 200)
    members = spark.createDataFrame([(i, int(t), [float(x) for x in row]) for i, (t, row) in enumerate(zip(tokens, p))],
                                    "doc_id long, tokens long, p array<double>")
    targets = {"a": 0.6, "b": 0.3, "c": 0.1}
    rows = mixing.fit_rates(members, ["a", "b", "c"], targets, steps=200).orderBy("doc_id").collect()
    rate = np.array([r["rate"] for r in rows])
    assert (rate >= 0).all() and (rate <= 1).all()
    share = np.array([0.6, 0.3, 0.1])
    goal = (tokens @ p / share).min() * share
    # the same steps, by arrays
    gram = (p * tokens[:, None]).T @ p / np.sqrt(np.outer(goal, goal))
    w, step = np.ones(200), 1 / mixing._largest_eigenvalue(gram.tolist())
    for _ in range(200):
        residual = (w * tokens) @ p - goal
        if (np.abs(residual) / goal).max() < mixing.CLOSE:
            break
        w = np.clip(w - step * p @ (residual / goal), 0, 1)
    assert np.allclose(rate, w)


def test_mixing_learns_domains_and_meets_targets(spark):
    docs = spark.createDataFrame([(i, ("awful " if i % 4 == 0 else "lovely ") + "and some words x%d" % i) for i in range(400)],
                                 "doc_id long, text string")
    labelled = spark.createDataFrame([(i, "bad" if i % 4 == 0 else "good") for i in range(200)], "doc_id long, domain string")
    rates, domains = mixing.mix(docs, labelled, {"good": 0.9, "bad": 0.1})
    rows = rates.collect()
    assert domains == ["bad", "good"] and len(rows) == 400
    assert all((r["p"][0] > 0.9) == (r["doc_id"] % 4 == 0) for r in rows)
    mass = {d: sum(r["rate"] * r["tokens"] * r["p"][i] for r in rows) for i, d in enumerate(domains)}
    assert mass["bad"] / sum(mass.values()) == pytest.approx(0.1, abs=0.01)
    assert min(r["rate"] for r in rows if r["doc_id"] % 4) > 0.95


def _members(spark, masses):
    """Documents of ten tokens that lie in one domain each."""
    rows = [(10 * i, [float(i == j) for j in range(len(masses))]) for i, n in enumerate(masses) for _ in range(n)]
    return spark.createDataFrame([(n, 10, p) for n, (_, p) in enumerate(rows)], "doc_id long, tokens long, p array<double>")


@pytest.mark.parametrize("masses, want", [
    ([900, 20, 80], [0.9 / 0.9, 0.06 / 0.02, 0.04 / 0.08]),  # scarce, but enough to aim at: repeated
    ([910, 2, 88], [0.998 * 0.9 / 0.94 / 0.91, 1.0, 0.998 * 0.04 / 0.94 / 0.088]),  # next to nothing: kept as it is
])
def test_a_scarce_domain_does_not_shrink_the_mix(spark, masses, want):
    rates = mixing.fit_rates(_members(spark, masses), ["clean", "low", "toxic"], queries.TARGETS, most=None)
    got = [r["r"] for r in rates.groupBy("p").agg(F.avg("rate").alias("r")).orderBy(F.desc("p")).collect()]
    assert np.allclose(got, want, rtol=0.05)
    tokens = rates.agg(F.sum(F.col("rate") * F.col("tokens"))).first()[0]
    assert tokens > 0.95 * 10 * sum(masses)


def test_priors_are_those_of_the_documents_present(spark):
    docs = spark.createDataFrame([(i, "some words x%d" % i) for i in range(100)], "doc_id long, text string")
    labelled = spark.createDataFrame([(i, "low" if i >= 95 else "clean") for i in range(1000)], "doc_id long, domain string")
    model = mixing.fit_classifier(docs, labelled)
    assert np.allclose(np.exp(model.priors), [0.95, 0.05])


def test_mixing_odd_and_empty(spark, odd, empty):
    labelled = spark.createDataFrame([(2, "a"), (3, "b"), (99, None), (None, "a")], "doc_id long, domain string")
    for labels in (labelled, labelled.limit(0)):
        rates, _ = mixing.mix(odd, labels, {"a": 1.0, "b": 1.0})
        assert rates.count() == odd.count()
        assert mixing.mix(empty, labels, {"a": 1.0})[0].count() == 0


def test_copies_follow_the_rate(spark):
    got = spark.range(20_000).select(mixing.copies(F.lit(1.25), F.col("id")).alias("n")).agg(F.avg("n"), F.max("n")).first()
    assert got[0] == pytest.approx(1.25, abs=0.02) and got[1] == 2


# ---- 2: licenses -------------------------------------------------------

def test_notices_exact_changed_and_buried(spark):
    mit = licenses.TEMPLATES["mit-permission"]
    changed = mit.replace("free of charge", "without any charge")
    filler = "Nothing of note is said here at all. "
    rows = [(1, "Before.\nReleased under the MIT License.\nAfter."), (2, filler * 3000 + mit + " " + filler * 3000),
            (3, changed), (4, filler * 10), (5, "You need a driving licence to drive a large car on a public road."),
            (6, licenses.TEMPLATES["apache-2.0"] + "\n" + licenses.TEMPLATES["cc-by-nc-4.0"]), (7, None), (8, "")]
    got = licenses.notices(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {}
    for r in got:
        found.setdefault(r["doc_id"], []).append(r)
    assert [r["license"] for r in found[1]] == ["mit"] and found[1][0]["exact"]
    assert [(r["license"], r["exact"]) for r in found[2]] == [("mit-permission", True)]
    assert found[2][0]["start"] <= len(filler) * 3000 <= found[2][0]["start"] + len(mit)
    (r,) = found[3]
    assert not r["exact"] and set(r["missing"]) >= {"free", "of"} and set(r["added"]) >= {"without", "any"}
    assert {r["license"] for r in found[6]} == {"apache-2.0", "cc-by-nc-4.0"}
    assert set(found) == {1, 2, 3, 6}


def test_notices_find_every_planted_line(documents, texts):
    lines = {"gpl-3.0", "mit", "cc-by-nc-4.0", "apache-2.0", "all-rights-reserved"}
    got = {(r["doc_id"], r["license"]) for r in licenses.notices(documents).collect()}
    want = {(i, n) for i, t in texts.items() for n in lines if licenses.TEMPLATES[n] in t}
    assert want <= got and {i for i, _ in got} == {i for i, _ in want}


def _found(text):
    scanner = licenses.Scanner(licenses.TEMPLATES)
    return [(n.license, not n.missing and not n.added) for _, n in scanner.scan(text.encode())]


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_wrapped_notices_are_found_word_for_word(name):
    import textwrap

    around = ["Nothing of note is said in the lines here.", "", "And so on it goes for the rest of the file."]
    for width in (20, 70, 76, 80):
        for prefix in ("", "# ", "// ", " * ", "-- ", ";; "):
            lines = textwrap.wrap(licenses.TEMPLATES[name], width, break_on_hyphens=False, break_long_words=False)
            text = "\n".join(prefix + x for x in [*around[:2], *lines, *around[1:]])
            assert _found(text) == [(name, True)], (width, prefix)


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_notices_are_found_at_any_distance_from_another_cue(name):
    for gap in range(0, 260, 9):
        for pieces in (("licences", licenses.TEMPLATES[name]), (licenses.TEMPLATES[name], "licences")):
            assert _found(f" {'word ' * gap}".join(pieces)) == [(name, True)], gap


def test_notices_are_found_in_long_runs_of_cues():
    header, mit = licenses.TEMPLATES["apache-2.0-header"], licenses.TEMPLATES["mit"]
    many = [mit, header, "Permission and licence of all kinds.", "All rights reserved."] * 60
    want = [n for n in ("mit", "apache-2.0-header", None, "all-rights-reserved") if n] * 60
    assert _found(" ".join(many)) == [(n, True) for n in want]


def test_a_long_form_does_not_hide_a_short_one():
    warranty = ("The software is provided as is, without warranty of any kind, express or implied, including but not limited "
                "to the warranties of merchantability, fitness for a particular purpose and noninfringement.")
    assert _found(f"Copyright 2020 by the authors of this file. {licenses.TEMPLATES['mit']} {warranty}") == [("mit", True)]
    text = ("Copyright 2019 the original author or authors, with permission of the copyright holders and of all the "
            "contributors listed. ")
    assert _found(text + licenses.TEMPLATES["apache-2.0"]) == [("apache-2.0", True)]
    for name, notice in licenses.TEMPLATES.items():
        assert _found(f"{text}{notice} {warranty}") == [(name, True)]


def test_compression_ranks_the_right_template_first():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, text in licenses.TEMPLATES.items():
        assert scanner.rank(" ".join(licenses.tokens(text)).encode())[0][1] == name


def test_what_compression_does_not_choose_is_not_found(monkeypatch):
    text = f"{licenses.TEMPLATES['mit']} {licenses.TEMPLATES['gpl-3.0']}"
    assert _found(text) == [("mit", True), ("gpl-3.0", True)]
    rank = licenses.Scanner.rank
    monkeypatch.setattr(licenses.Scanner, "rank", lambda self, block: [r for r in rank(self, block) if r[1] != "mit"])
    assert _found(text) == [("gpl-3.0", True)]
    monkeypatch.setattr(licenses.Scanner, "rank", lambda self, block: [(0.0, *r[1:]) for r in rank(self, block)])
    assert _found(text) == []


def test_notices_odd_and_empty(odd, empty):
    assert licenses.notices(odd).count() == 0 and licenses.notices(empty).count() == 0


# ---- 3: quality --------------------------------------------------------

def test_discriminant_equals_explicit_densities():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0, 2, (300, 3)), rng.normal(1, 0.5, (900, 3))])
    y = np.repeat([0.0, 1.0], [300, 900])
    m = quality.fit_model(x, y)
    for k in (0, 1):
        cov = m.factors[k] @ m.factors[k].T
        d = x - m.means[k]
        direct = -0.5 * np.einsum("ni,ij,nj->n", d, np.linalg.inv(cov), d) - 0.5 * np.linalg.slogdet(cov)[1]
        assert np.allclose(m.log_density(x, k), direct)
    s = m.score(x)
    assert ((s > 0.5) == (y == 1)).mean() > 0.85 and (s >= 0).all() and (s <= 1).all()


def test_quality_held_out(spark, sf_small):
    got = queries.op3_quality(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.95


def test_quality_odd_and_empty(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1), (5, 0), (None, 1), (2, None)], "doc_id long, quality int")
    for some in (labels, labels.where("quality = 1"), labels.limit(0)):
        model = quality.fit(odd, some)
        rows = quality.scores(odd, model).collect()
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert quality.scores(empty, model).count() == 0


# ---- 4: sharding -------------------------------------------------------

def brute_shards(rows: list[tuple[int, int]], limit: int) -> dict[int, tuple]:
    bits = {i: format(int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), "060b") for i, _ in rows}
    out = {}

    def split(members, depth):
        size = sum(b for _, b in members)
        if size <= limit or len(members) == 1:
            for i, _ in members:
                out[i] = (bits[i][:depth], depth, size, len(members))
            return
        for bit in "01":
            if part := [m for m in members if bits[m[0]][depth] == bit]:
                split(part, depth + 1)

    split(rows, 0)
    return out


@pytest.mark.parametrize("limit", [10_000, 100_000, 10_000_000])
def test_shards_equal_splitting_by_hand(documents, texts, limit):
    want = brute_shards([(i, len(t.encode())) for i, t in texts.items()], limit)
    got = {r["id"]: tuple(r)[1:] for r in sharding.place(documents, limit).collect()}
    assert got == want


@pytest.mark.parametrize("limit", [20_000])
def test_shards_equal_sql(spark, sf_small, documents, limit):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_small}/documents.parquet')")
    want = {r[0]: r[1:] for r in con.execute(sharding.place_sql(limit)).fetchall()}
    assert {r["id"]: tuple(r)[1:] for r in sharding.place(documents, limit).collect()} == want


def test_shards_of_a_hot_key_and_equal_rows(spark):
    rows = [(i, "x" * 100, "hot") for i in range(300)] + [(7, "y" * 100, "same")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sharding.place(df, 1000, key="source").collect()
    assert len(got) == 350 and max(r["shard_bytes"] for r in got) <= 1000
    sizes = {}
    for r in got:
        sizes.setdefault(r["shard"], []).append(r)
    assert all(len(v) == v[0]["shard_rows"] for v in sizes.values())


def test_shards_odd_empty_and_files(spark, odd, empty, documents, tmp_path):
    assert sharding.place(odd, 1000).count() == odd.count()
    assert sharding.place(empty, 1000).count() == 0
    sharding.write(documents, str(tmp_path / "shards"), 50_000)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == documents.count()
    assert back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).where(
        "b > 50000 and n > 1").count() == 0


def test_written_shards_hold_every_row_once(spark, tmp_path):
    rows = [(i, x, "s") for i, x in [(1, "a" * 50)] * 40 + [(None, "b" * 60)] * 5 + [(1, "c" * 70), (2, None), (3, "d" * 500)]]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    sharding.write(df, str(tmp_path / "out"), 120)
    back = spark.read.parquet(str(tmp_path / "out"))
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=key) == sorted((r[:2] for r in rows), key=key)
    sizes = back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).collect()
    assert all(r["n"] == 1 or (r["b"] or 0) <= 120 for r in sizes) and len(sizes) > 20


# ---- 5: SentencePiece --------------------------------------------------

ODD = ["", " ", "  ", "a ", " a", "a  b", "\n", "a\n b", "▁x", "x ▁ y", "日本 語̀ \x00 x", "😀 😀😀", "<s> </s> <unk>",
       "İ ﬁ Å", " \t x", "a" * 300, "a b", "  lead", "trail   "]


def test_sentencepiece_equals_the_library(texts):
    codec = spm_codec.Codec(queries.tokenizer(queries.PIECES))
    assert codec.by_segment
    for text in [*ODD, *texts.values()]:
        data = text.encode()
        ids, starts, ends = codec.encode(data)
        assert ids.tolist() == codec.lib.encode(text)
        assert codec.decode(ids) == codec.lib.decode(codec.lib.encode(text))
        assert (starts[1:] == ends[:-1]).all() and (not len(ids) or (starts[0], ends[-1]) == (0, len(data)))


def test_sentencepiece_spans_equal_the_library(texts):
    """Every piece's span is the library's own offset (in bytes)."""
    codec = spm_codec.Codec(queries.tokenizer(queries.PIECES))
    for text in [*ODD, *texts.values()]:
        data = text.encode()
        _, starts, ends = codec.encode(data)
        want = [(p.begin, p.end) for p in codec.lib.encode(text, return_type="proto").pieces]
        assert list(zip(starts.tolist(), ends.tolist())) == want, text


def test_sentencepiece_normalises_every_text(monkeypatch):
    """Ids and spans come from the normalised text and its record."""
    codec = spm_codec.Codec(queries.tokenizer(queries.PIECES))
    right = codec.encode(b"some words here")
    monkeypatch.setattr(codec, "normalise", lambda data: ("▁other▁text".encode(), np.zeros(16, int)))
    ids, starts, ends = codec.encode(b"some words here")
    assert ids.tolist() == codec.lib.encode("other text") != right[0].tolist() and not ends.any()
    codec.by_segment = False
    with pytest.raises(ValueError):
        codec.encode(b"some words here")


def test_sentencepiece_identity_map_equals_the_general_one():
    codec, other = (spm_codec.Codec(queries.tokenizer(queries.PIECES)) for _ in range(2))
    other.map.units = (0,)  # a map that finds nothing
    for text in ODD:
        (a, b), (c, d) = codec.normalise(text.encode()), other.normalise(text.encode())
        assert a == c and b.tolist() == d.tolist()


def test_sentencepiece_spans_by_general_way(texts):
    """The way for any model agrees with the remembered segments."""
    fast, slow = (spm_codec.Codec(queries.tokenizer(queries.PIECES)) for _ in range(2))
    slow.by_segment = False
    for text in [*ODD, *list(texts.values())[:20]]:
        for a, b in zip(fast.encode(text.encode()), slow.encode(text.encode())):
            assert a.tolist() == b.tolist()


def test_character_map_equals_the_library():
    """Longest-prefix rewriting by a compiled map that does rewrite."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as schema

    model = schema.NormalizerSpec()
    made = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    proto = schema.ModelProto()
    proto.ParseFromString(made.serialized_model_proto())
    model = proto.normalizer_spec
    charmap = spm_codec.CharMap(model.precompiled_charsmap)
    codec = spm_codec.Codec(queries.tokenizer(queries.PIECES))
    for extra in (False, True):
        model.add_dummy_prefix = model.escape_whitespaces = False
        model.remove_extra_whitespaces = extra
        lib = sentencepiece.SentencePieceNormalizer(normalizer_spec=model)
        codec.rules, codec.map = model, charmap
        for text in ["ﬁne ①② ｱｲ", "Å é ９９", " a  b ", "ｶﾞ ガ", "x​y z", "㌕", "plain", ""]:
            normal, origin = codec.normalise(text.encode())
            assert normal.decode() == lib.normalize(text)
            assert len(origin) == len(normal) + 1 and (np.diff(origin) >= 0).all()
    whole, place = charmap.longest("ﬁne".encode(), 0)
    assert whole == 3 and charmap.step("ﬁne".encode(), 0) == (3, b"fi")


def test_sentencepiece_query(spark, documents, odd, empty):
    codec = spm_codec.Codec(queries.tokenizer(queries.PIECES))
    path = queries.tokenizer(queries.PIECES)
    for df in (documents, odd):
        for r in spm_codec.encode(df, path).collect():
            ids = codec.lib.encode(r["row"]["text"] or "", add_bos=True, add_eos=True)
            assert r["ids"] == ids and np.frombuffer(r["ids_le"], "<u4").tolist() == ids
            assert r["decoded"] == codec.lib.decode(ids) and len(r["starts"]) == len(r["ends"]) == len(ids)
            assert np.frombuffer(r["spans_le"], "<i4").reshape(-1, 2).tolist() == [list(x) for x in zip(r["starts"], r["ends"])]
    assert spm_codec.encode(empty, path).count() == 0
    clash = documents.limit(3).withColumn("ids", F.lit(1)).withColumn("row", F.lit(2)).withColumn("odd name`s", F.lit(3))
    assert spm_codec.encode(clash, path).select("row.*").columns == clash.columns


# ---- 7: SimHash --------------------------------------------------------

def brute_print(text: str | None) -> int:
    import xxhash

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: list[int], radius: int) -> list[int]:
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(prints))]


def test_simhash_equals_brute_force(documents, texts):
    ids = sorted(texts)
    prints = [brute_print(texts[i]) for i in ids]
    want = {i: (format(p, "016x"), ids[c]) for i, p, c in zip(ids, prints, brute_components(prints, 2))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(documents).collect()}
    assert got == want


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_span_chains_and_tiles(spark, monkeypatch, radius):
    """A chain of fingerprints one bit apart, clusters and far ones, with
    runs longer than a tile."""
    monkeypatch.setattr(simhash, "TILE", 8)
    rng = np.random.default_rng(radius)
    chain, x = [], 0x0123456789ABCDEF
    for b in rng.permutation(64)[:40]:
        x ^= 1 << int(b)
        chain.append(x)
    near = [0xF0F0 << 40 ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (40, 2))]
    prints = sorted({*chain, *near, *map(int, rng.integers(0, 2 ** 63, 60))})
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    links = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(df, radius).collect()]
    assert all((a ^ b).bit_count() <= radius for a, b in links)
    place = {p: i for i, p in enumerate(prints)}
    found = brute_components(prints, radius)
    roots = {r["node"] % (1 << 64): r["root"] for r in simhash.components(
        spark.createDataFrame([(a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b) for a, b in links],
                              "a long, b long")).collect()}
    groups = {}
    for p in prints:
        groups.setdefault(roots.get(p, ("alone", p)), set()).add(place[p])
    want = {}
    for i, c in enumerate(found):
        want.setdefault(c, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_near_counts_every_lane():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2 ** 63, 70, dtype=np.uint64)
    fps[20:40] = fps[0] ^ (np.uint64(1) << rng.integers(0, 64, 20).astype(np.uint64))
    vertical = simhash.planes(fps, list(range(64)))
    for shift in (1, 3, 25):
        for radius in (0, 1, 2, 3):
            valid = simhash.pack(np.arange(70) < 70 - shift)
            got = simhash.lanes(simhash.near(vertical, shift, valid, radius), 70)
            want = np.flatnonzero(np.bitwise_count(fps[:-shift] ^ fps[shift:]) <= radius)
            assert got.tolist() == want.tolist()


def test_simhash_odd_and_empty(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add((r["fingerprint"], r["component_id"]))
    assert by[1] == by[2] == {("0" * 16, 1)} and by[4] == {("0" * 16, 1)}
    assert by[5] == {(f, 5) for f, _ in by[6]}
    assert simhash.near_duplicates(empty).count() == 0


# ---- 8: token files ----------------------------------------------------

def test_token_files_equal_the_library(spark, documents, texts, odd, empty, tmp_path):
    from tokenizers import Tokenizer

    path = queries.tokenizer(queries.WORDS)
    lib = Tokenizer.from_file(path)
    files = token_files.write_token_files(documents, str(tmp_path / "a"), path, length=128)
    got = {r["doc_id"]: r for r in token_files.read_documents(files).collect()}
    at, stream = 0, []
    for i in sorted(texts):
        ids = np.array(lib.encode(texts[i], add_special_tokens=False).ids + [1], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
        stream.append(ids)
    stream, back = np.concatenate(stream), []
    for f in files.orderBy("part").collect():
        reader = token_files.TokenFile(f["tokens"])
        assert reader.length == 128
        for s in range(-(-f["n_tokens"] // 128)):
            ids, mask = reader.sequence(s)
            assert len(ids) == len(mask) == 128
            back.append(ids[np.array(mask.to_pylist())])
    assert np.concatenate(back).tolist() == stream.tolist()
    rows = token_files.read_documents(token_files.write_token_files(odd, str(tmp_path / "b"), path)).collect()
    assert len(rows) == odd.count()
    assert token_files.read_documents(token_files.write_token_files(empty, str(tmp_path / "c"), path)).count() == 0


def test_chunks_encode_like_whole_texts():
    enc = token_files.ChunkEncoder(queries.tokenizer(queries.WORDS), "<u2")
    odd = [*ODD, None, "it's I'LL don't 12ab3 a_b", "<|endoftext|>x <|startoftext|>", "<|ENDOFTEXT|>", "ÀÉ é é Σς ΑΣ",
           "\x1c\x1dab\x1f c", "a b　c", "́x ́", "x\x0by\x0cz\x85w", "×÷ÿß¿", "a­b", "\x00 \x7f", "Word. Word, word.,"]
    for texts in (odd, [t for t in odd if t and "<" not in t]):
        ids, at = enc.encode(pa.array(texts, pa.string()))
        for i, t in enumerate(texts):
            assert ids[at[i]:at[i + 1]].tolist() == enc.lib.encode(t or "", add_special_tokens=False).ids


# ---- 9: language -------------------------------------------------------

def test_filter_has_no_false_negative_and_few_positives():
    rng = np.random.default_rng(0)
    grams = [rng.integers(0, 2 ** 63, 3000, dtype=np.uint64) for _ in range(70)]
    f = language.Filter.build([(f"l{i:02d}", g) for i, g in enumerate(grams)])
    for i in (0, 63, 64, 69):
        assert f.counts(grams[i], np.array([0]))[0, i] == len(grams[i])
    foreign = rng.integers(0, 2 ** 63, 20000, dtype=np.uint64)
    counts = f.counts(foreign, np.array([0]))[0]
    assert np.abs(counts / 20000 - f.false_positives()).max() < 0.01


def test_language_held_out(spark):
    rows = queries.op9_language(spark, "/root/testdata/sf0.01").collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held) and len(rows) == len(lang)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97


def test_language_counts_equal_one_by_one(texts):
    text = list(texts.values())[0]
    codes = language.letter_runs(text)
    plain = re.sub(r"[\W\d_]+", "\0", "\0" + text.lower() + "\0")
    assert codes.tolist() == [ord(c) for c in plain]
    hashes = language.gram_hashes(codes, 3)
    again = {}
    for i, h in enumerate(hashes.tolist()):
        assert again.setdefault(plain[i:i + 3], h) == h


def test_long_texts_are_taken_in_pieces(monkeypatch):
    text = "abcdefghij" * 50
    whole = sorted(h for part in language.grams(text) for h in part.tolist())
    monkeypatch.setattr(language, "CHARS", 64)
    pieces = {h for part in language.grams(text) for h in part.tolist()}
    assert set(whole) <= pieces


def test_language_odd_and_empty(odd, empty):
    learned = language.fit(odd)
    rows = language.predict(odd, learned).collect()
    assert len(rows) == odd.count()
    by = {(r["row"]["doc_id"], r["row"]["text"]): (r["lang_pred"], r["score"]) for r in rows}
    assert by[1, None] == by[2, ""] == by[7, "12 34 !!"] == (language.UNKNOWN, 0.0)
    assert by[3, "one"][0] in learned.languages
    assert language.predict(empty, learned).count() == 0
    assert {r["lang_pred"] for r in language.predict(odd, language.fit(empty)).collect()} == {language.UNKNOWN}


def test_a_repeated_id_fills_several_token_files(spark, tmp_path):
    df = spark.range(6000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    merge = "spark.sql.adaptive.coalescePartitions.enabled"  # small ranges would be one task's
    before = spark.conf.get(merge)
    spark.conf.set(merge, "false")
    try:
        files = token_files.write_token_files(df, str(tmp_path / "t"), queries.tokenizer(queries.WORDS))
    finally:
        spark.conf.set(merge, before)
    sizes = [r["n_docs"] for r in files.collect()]
    assert sum(sizes) == 6000 and len(sizes) >= 4 and max(sizes) < 3000
    rows = token_files.read_documents(files).orderBy("start").collect()
    assert len(rows) == 6000 and [r["start"] for r in rows] == list(np.cumsum([0] + [r["n_tokens"] for r in rows[:-1]]))

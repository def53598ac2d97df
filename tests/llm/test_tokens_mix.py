"""Token files, mixing and the pipeline."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from ledgerlake.llm import mixing, tokenfile

PATH = public_tokenizers.path("byte_bpe_50k.json")


def docs(spark, rows):
    return spark.createDataFrame([(d, t, s, "x", 0) for d, t, s in rows], "doc_id long, text string, source string, row string, size long")


def test_coder_round_trip():
    rng = np.random.default_rng(1)
    for n, top in ((0, 5), (1, 5), (7, 1), (5000, 50), (40_000, 60_000)):
        ids = (rng.zipf(1.3, n) % top).astype(np.uint32)
        freq = tokenfile.scaled(np.bincount(ids, minlength=top), 18)
        c = tokenfile.Coder(freq, 18, lanes=64, checkpoint=8)
        block = c.encode(ids)
        assert (c.decode(block) == ids).all()
        if n == 5000:
            assert freq.sum() == 1 << 18 and len(block) < 2 * n
            parts = [c.decode(block, k) for k in range(-(-n // 64 // 8) if n % 512 == 0 else n // 512 + 1)]
            assert (np.concatenate(parts) == ids).all()
            bad = bytearray(block)
            bad[-3] ^= 1
            with pytest.raises(ValueError):
                c.decode(bytes(bad))


def test_encoding_equals_the_library():
    import pyarrow as pa

    from ledgerlake.llm import common as C

    own = tokenfile.Encoder(PATH)
    rng = random.Random(2)
    texts = [None, "", " ", "a<|endoftext|> b it's can't.DON'T,,'s", " x  y z", "a  b\x1c \x1fc", "  lead", "trail  ", "x²³ 12a", "'s"]
    texts += ["".join(rng.choice("ab c\n\t'.,-é  1#9s t<|>") for _ in range(rng.randint(0, 50))) for _ in range(2000)]
    data, off = C.text_bytes(pa.array(texts))
    for limit in (1 << 22, 60):
        got = []
        for i, j in C.slices(off, limit):
            ids, n = tokenfile.encode_slice(data[off[i] : off[j]], off[i : j + 1] - off[i], own)
            ends = np.cumsum(n)
            got += [ids[e - k : e].tolist() for e, k in zip(ends, n)]
        assert got == [own.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_token_file(spark, tmp_path):
    from tokenizers import Tokenizer

    rows = [(i, f"text number {i} " * (i % 50), "s") for i in range(300, 0, -1)] + [(500, None, "s"), (501, "", None), (None, "last", "s")]
    tokenfile.write(docs(spark, rows).repartition(3), f"file://{tmp_path}/t", PATH)
    got = tokenfile.read(spark, f"file://{tmp_path}/t", whole=True).collect()
    t, start, want = Tokenizer.from_file(PATH), 0, []
    for d, x, _ in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        want.append((d, start, len(ids) // 4, zlib.crc32(ids), ids))
        start += len(ids) // 4
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in got), key=lambda x: x[1]) == want
    block = spark.read.parquet(f"file://{tmp_path}/t/blocks").orderBy("shard", "block").first()
    ids = np.concatenate([np.frombuffer(x[4], "<u4") for x in want])[: block.n]
    step = tokenfile.CHECKPOINT * min(tokenfile.LANES, block.n)
    parts = [tokenfile.read_part(spark, f"file://{tmp_path}/t", block.shard, block.block, k) for k in range(-(-block.n // step))]
    assert (np.concatenate(parts) == ids).all()
    tokenfile.write(docs(spark, rows).limit(0), f"file://{tmp_path}/e", PATH)
    assert tokenfile.read(spark, f"file://{tmp_path}/e").count() == 0


def plain_targets(sizes):
    """Excess shared again and again, as told."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        live = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in live) for s in live}
        over = [s for s in live if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in over}


def test_mixture(spark):
    rng = random.Random(3)
    source = lambda: rng.choice(["a"] * 3 + ["b", "c"] * 8 + ["d", "é", None])
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 50, 200])), source()) for i in range(1500)] + [(9000, None, "a"), (9001, None, "empty"), (None, "x y", "a"), (7, "w w w", "b"), (7, "w w w", "b")]
    df = docs(spark, rows)
    got = mixing.mixture(df.repartition(5)).collect()
    sizes, taken = {}, {}
    src = {(d, len((t or "").split())): s for d, t, s in rows}
    for r in got:
        s = src[r.doc_id, r.size]
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
    want = plain_targets(sizes)
    for r in got:
        s = src[r.doc_id, r.size]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6
    assert all(abs(taken[s] - want[s]) <= 200 for s in sizes)
    again = mixing.mixture(df.repartition(2)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.copies for r in got)
    assert mixing.mixture(df.limit(0)).count() == mixing.mix(df.limit(0)).count() == 0


def plain_copies(rows, targets, sizes, cap=3):
    """Copies of every (doc_id, size, source): whole ones, then the prefix of random odds over inclusion odds that comes nearest."""
    import xxhash

    def uniform(d):
        h = xxhash.xxh64(mixing.SEED.to_bytes(4, "little"), 42).intdigest()
        h = h if d is None else xxhash.xxh64(d.to_bytes(8, "little", signed=True), h).intdigest()
        return ((h >> 11) + 0.5) / 2**53

    out = {}
    for s in sizes:
        own = [(d, n) for d, n, x in rows if x == s and n > 0]
        if not own:
            continue
        e = targets[s] / sizes[s]
        sure = int(e + 1e-9)
        f = max(e - sure, 0.0)
        out |= {(d, n, s): sure for d, n in own}
        if f > 1e-9:
            odds = {d: uniform(d) / (1 - uniform(d)) * (1 - f) / f for d, _ in own}
            left, total, best = targets[s] - sure * sum(n for _, n in own), 0, (targets[s] - sure * sum(n for _, n in own), 0)
            order = sorted(own, key=lambda x: odds[x[0]])
            for k, (_, n) in enumerate(order, 1):
                total += n
                if abs(total - left) < best[0]:
                    best = abs(total - left), k
            for d, n in order[: best[1]]:
                out[d, n, s] += 1
    return out


def test_draw_equals_the_plain_order(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.choice([1, 5, 50, 200, 1000])), rng.choice(["a"] * 6 + ["b", "c"] * 4 + ["d", None])) for i in range(900)]
    sizes = {}
    sized = [(d, len(t.split()), s) for d, t, s in rows]
    for _, n, s in sized:
        sizes[s] = sizes.get(s, 0) + n
    want = plain_copies(sized, plain_targets(sizes), sizes)
    by = {d: s for d, _, s in sized}
    got = {(r.doc_id, r.size, by[r.doc_id]): r.copies for r in mixing.mixture(docs(spark, rows).repartition(4)).collect()}
    assert got == want and len(set(want.values())) > 2


def test_pipeline_on_awkward_rows(spark, tmp_path):
    """The chain against plain versions of its stages: null ids and texts, repeated rows, columns of clashing names."""
    import sentencepiece

    from ledgerlake.llm import pii, quality
    from tests.llm import brute

    rng = random.Random(6)
    clean = lambda: " ".join(rng.choice("the of and river stone light water moon tree house wind".split()) + rng.choice(["", "s", ","]) + str(rng.randint(0, 9)) for _ in range(90))
    base = [clean() for _ in range(40)]
    rows = [(i, t, "ab"[i % 2]) for i, t in enumerate(base)] + [(100 + i, base[i] + " tail", "b") for i in range(10)]
    rows += [(200, base[0], "a"), (200, base[0], "a"), (None, clean(), "a"), (None, clean(), None), (300, None, "b"), (301, "", "a"), (302, "too short", "b"), (303, "x y z " * 60, "a"), (304, clean() + ' mail bob@h.org token = "a1b2c3d4e5f60718293a4b5c" ok', "b")]
    df = spark.createDataFrame([(d, t, s, "k", 7, "p") for d, t, s in rows], "doc_id long, text string, source string, key string, size int, part string")
    df.write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(303, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    folder = f"file://{tmp_path}"
    now = corpus_pipeline.quality_rules(spark, df, folder)
    verdict = {r.doc_id: r.kept for r in quality.judge(df, spark.read.parquet(f"{folder}/labels.parquet")).collect() if r.doc_id is not None}
    kept = [r for r in now.collect()]
    assert now.columns == df.columns and {r.doc_id for r in kept if r.doc_id is not None} == {d for d, k in verdict.items() if k} and not {300, 301, 302, 303} & {r.doc_id for r in kept}
    now = corpus_pipeline.near_dedup(spark, now, folder)
    left = now.collect()
    ids = {n: (r.doc_id if r.doc_id is not None else 10**6 + n, r.text) for n, r in enumerate(kept)}
    want = {d for d, _, c, k in brute.near_components(list({i: (i, t) for i, t in ids.values()}.values()), 5) if k}
    assert len(left) == len(want) and {r.doc_id for r in left if r.doc_id is not None} == {d for d in want if d < 10**6} and now.columns == df.columns
    now = corpus_pipeline.personal_data(spark, now, folder)
    red = {r.doc_id: r.text for r in now.collect()}
    assert "<EMAIL>" in red[304] and "<SECRET>" in red[304] and sum(r.text != red[r.doc_id] for r in left if r.doc_id is not None) == 1 and now.columns == df.columns
    held = now.collect()
    now = corpus_pipeline.source_mixing(spark, now, folder)
    sizes = {}
    for r in held:
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    copies = plain_copies([(r.doc_id, len(r.text.split()), r.source) for r in held if r.doc_id is not None], plain_targets(sizes), sizes)
    got = {}
    for r in now.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    sure = {s for s in sizes if all(r.doc_id is not None for r in held if r.source == s)}
    assert all(got.get(d, 0) == c for (d, _, s), c in copies.items() if s in sure) and now.columns == df.columns
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    mixed = now.collect()
    out = corpus_pipeline.sentencepiece_ids(spark, now, folder).collect()
    assert sorted((str(r.doc_id), tuple(r.ids)) for r in out) == sorted((str(r.doc_id), tuple(sp.encode(r.text))) for r in mixed)
    assert corpus_pipeline.run(spark, folder).count() == len(mixed)
    assert pii.find(df).count() == len(rows)


def test_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    docs_ = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near dedup", "personal data", "source mixing", "sentencepiece"]
    now, counts = docs_, [docs_.count()]
    for _, stage in corpus_pipeline.STAGES[:3]:
        now = stage(spark, now, folder)
        assert now.columns == docs_.columns
        counts.append(now.count())
    assert counts[0] > counts[1] > counts[2] == counts[3]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs_.limit(0), folder).count() == 0
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))

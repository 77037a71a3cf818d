"""Decontamination, language ID, secrets, fingerprints: small fixtures against plain Python."""

import hashlib
import random
from math import log2

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keyfig.llm import common, decontaminate, fingerprint, langid, secrets

SCHEMA = "doc_id long, text string"


# ------------------------------------------------------------------------------- words

def test_words_do_not_cross_rows_and_pieces_agree(monkeypatch):
    texts = ["Ab", "cd Éa-ab", "", "x" * 50 + " y", "ab", "a", "b"]
    whole = common.word_hashes(*common.text_bytes(pa.array(texts)))
    monkeypatch.setattr(common, "STEP_BYTES", 7)
    cut = common.word_hashes(*common.text_bytes(pa.array(texts)))
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
    counts = np.diff(whole[1]).tolist()
    assert counts == [1, 3, 0, 2, 1, 1, 1]
    h = whole[0]
    assert h[0] == h[6] and len(set(h.tolist())) == 7   # "Ab" and "ab": one hash


# ------------------------------------------------------------------------------- op 1

ITEMS = [("1", "one two three four five six seven eight nine ten eleven twelve"), ("2", "Short item"), ("10", "short   ITEM!"),
         ("3", None), ("4", "..."), (None, "never an item"), ("5", "one two three four five six seven eight nine ten"),
         ("6", "é ü é ü é ü é ü é ü é ü"), ("5", "again the fifth")]
DOCS = [(1, "Zero one two three four five six seven eight nine ten eleven twelve thirteen"), (2, None), (3, ""), (4, "a short item, short item"),
        (4, "a short item, short item"), (None, "One-Two three FOUR five six seven eight nine ten"), (6, "É ü é ü é ü é ü é ü é ü é"),
        (7, "one two three four five six seven eight nine"), (8, "... !!"), (9, "short"), (10, "item short"), (11, "never an item again the fifth")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontamination_equals_brute_force(spark, block_bytes):
    docs = spark.createDataFrame([(*d, "x") for d in DOCS], SCHEMA + ", n_hit string")   # a clashing name
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    found, name = decontaminate.find_matches(docs, items, block_bytes=block_bytes)
    got = sorted((str(r["doc_id"]), r[name]["n_words"], r[name]["n_hit"], len(r[name]["items"]),
                  hashlib.sha256(",".join(r[name]["items"]).encode()).hexdigest()) for r in found.collect())
    items_ = [(i, t) for i, t in ITEMS if i is not None]
    want = []
    for d, t in DOCS:
        want += [(str(d), *v) for v in decontaminate.brute_force([(d, t)], items_).values()]
    assert got == sorted(want)
    clean = decontaminate.clean(docs, items, block_bytes=block_bytes)
    assert clean.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(["2", "3", "7", "8", "9", "10"])


def test_longest_matches_and_empty_tables(spark):
    docs, items = spark.createDataFrame(DOCS, SCHEMA), spark.createDataFrame(ITEMS, "item_id string, text string")
    found, name = decontaminate.find_matches(docs.where("doc_id = 1"), items)
    m = {(x["item_id"], x["item_start"], x["start"], x["length"]) for x in found.first()[name]["matches"]}
    assert m == {("1", 0, 1, 12), ("5", 0, 1, 10)}
    none, name = decontaminate.find_matches(docs, items.limit(0))
    assert none.where(F.col(f"{name}.n_hit") > 0).count() == 0 and none.count() == len(DOCS)
    assert decontaminate.clean(docs.limit(0), items).count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_items_without_an_id_are_searched(spark, block_bytes, tmp_path):
    from keyfig.llm.queries import op1_decontamination
    text = lambda a: " ".join(f"w{k}" for k in range(a, a + 12))
    items = spark.createDataFrame([(None, text(0)), (None, text(100)), ("x", text(200))], "item_id string, text string")
    docs = spark.createDataFrame([(1, text(0)), (2, text(100) + " and " + text(200)), (3, text(300))], SCHEMA)
    out, name = decontaminate.find_matches(docs, items, block_bytes=block_bytes, null_ids=True)
    got = {r["doc_id"]: (r[name]["n_hit"], list(r[name]["items"])) for r in out.collect()}
    assert got == {1: (12, []), 2: (24, ["x"]), 3: (0, [])}
    assert [r["doc_id"] for r in decontaminate.clean(docs, items, block_bytes=block_bytes, null_ids=True).collect()] == [3]
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    hit = {r["doc_id"]: (r["n_hit"], r["n_items"], r["contaminated"]) for r in op1_decontamination(spark, str(tmp_path)).collect()}
    assert hit == {1: (12, 0, True), 2: (24, 1, True), 3: (0, 0, False)}
    assert [r["doc_id"] for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()] == [3]


def test_decontamination_of_random_texts(spark):
    rnd = random.Random(5)
    text = lambda n: " ".join(rnd.choice("abc") for _ in range(n))
    items = [(str(i), text(rnd.randint(0, 14))) for i in range(12)]
    docs = [(i, text(rnd.randint(0, 400))) for i in range(30)]
    found, name = decontaminate.find_matches(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id string, text string"))
    got = {r["doc_id"]: (r[name]["n_words"], r[name]["n_hit"], len(r[name]["items"]), hashlib.sha256(",".join(r[name]["items"]).encode()).hexdigest())
           for r in found.collect()}
    assert got == decontaminate.brute_force(docs, items)


# ------------------------------------------------------------------------------- op 3

def test_code_lengths_are_those_of_the_escape_model(monkeypatch):
    monkeypatch.setattr(langid, "SYMBOLS", 4)
    rnd = np.random.default_rng(3)
    s = rnd.integers(0, 4, 300).astype(np.uint8)
    code = langid.codes(s, np.array([0, 200, 300]))
    counts = np.bincount(code, minlength=256)
    table = langid._code_lengths(np.flatnonzero(counts), counts[counts > 0])
    seen: dict[tuple, list[int]] = {}
    for a, b in ((0, 200), (200, 300)):
        padded = [0, 0, 0, *s[a:b].tolist()]
        for k in range(3, len(padded)):
            for order in range(4):
                seen.setdefault(tuple(padded[k - order:k]), [0] * 4)[padded[k]] += 1

    def probability(context: tuple, symbol: int) -> float:
        shorter = probability(context[1:], symbol) if context else 1 / 4
        c = seen.get(context)
        if not c:
            return shorter
        return max(0, c[symbol] - 0.5) / sum(c) + sum(x > 0 for x in c) / 2 / sum(c) * shorter

    for gram in rnd.integers(0, 256, 60):
        context = (gram // 64, gram // 16 % 4, gram // 4 % 4)
        assert abs(table[gram] / 256 + log2(probability(context, gram % 4))) < 1 / 256


def test_lengths_add_up_over_steps():
    model = langid.Model(["a", "b"], np.minimum(np.arange(256), 47).astype(np.uint8), [(np.arange(0, 48**4, k), np.arange(0, 48**4, k) % 5 + 1) for k in (7, 3)])
    texts = ["", "Hello, world", None, "x", "été\n" * 50]
    bits, n = model.lengths(*common.text_bytes(pa.array(texts)))
    alone = [model.lengths(*common.text_bytes(pa.array([t], pa.string()))) for t in texts]
    assert np.allclose(bits, np.concatenate([b for b, _ in alone])) and n.tolist() == [int(m[0]) for _, m in alone]


def test_language_of_held_out_documents(spark):
    from keyfig.llm.queries import op3_language_id
    sf = "/root/testdata/sf0.01"
    got = op3_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out")
    assert held.where("lang_pred = lang").count() >= 0.98 * held.count() > 100
    assert got.where("score < 0 OR score > 1").count() == 0


def test_every_language_has_a_model(spark, monkeypatch):
    rnd = random.Random(9)
    names = [f"l{k:02}" for k in range(70)]
    words = {x: ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)] for x in names}
    rows = [(i, " ".join(rnd.choices(words[x], k=30)), x) for i, x in enumerate(x for x in names for _ in range(3))]
    docs = spark.createDataFrame(rows, SCHEMA + ", lang string").repartition(3)
    model = langid.fit(docs)
    assert model.languages == names and len(model.blocks()) == 2
    texts = [(i, " ".join(rnd.choices(words[x], k=30)), x) for i, x in enumerate(names)] + [(100, "12", "und"), (100, "12", "und")]
    out, name = langid.predict(spark.createDataFrame(texts, SCHEMA + ", row string"), model)
    got = out.collect()
    assert out.columns == ["doc_id", "text", "row", name] and len(got) == len(texts)
    assert all(r[name]["lang"] == r["row"] for r in got)
    whole = model.predict(pa.array([r["text"] for r in got])).to_pylist()
    assert all(r[name]["bits"] == w["bits"] and abs(r[name]["score"] - w["score"]) < 1e-12 for r, w in zip(got, whole, strict=True))


def test_scripts_are_told_apart(spark):
    rnd = random.Random(4)
    spans = {"xa": 0x430, "xb": 0x561, "xc": 0x5D0, "xd": 0x905, "xe": 0x985, "xf": 0xE01, "xg": 0x10D0, "xh": 0x1200}
    # two languages a script, of the same letters, told apart by their order alone
    words = {f"{x}{k}": ["".join(chr(a + rnd.randrange(26)) for _ in range(5)) for _ in range(15)] for x, a in spans.items() for k in range(2)}
    words["latin"] = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(15)]
    text = lambda x: " ".join(rnd.choices(words[x], k=25))
    sizes = {x: 200 if x == "latin" else 6 for x in words}
    train = [(i, text(x), x) for i, x in enumerate(x for x, n in sizes.items() for _ in range(n))]
    model = langid.fit(spark.createDataFrame(train, SCHEMA + ", lang string"))
    assert len(model.groups) > 1
    for columns, group in model.groups:  # a frequent byte is no shared one in its language's group
        for k in columns:
            data, offsets = langid.folded(*common.text_bytes(pa.array([text(model.languages[k]) for _ in range(20)])))
            assert (group.symbol[data] == langid.SYMBOLS - 1).mean() < 0.05
    got = model.predict(pa.array([text(x) for x in words])).to_pylist()
    assert [r["lang"] for r in got] == list(words)


@pytest.mark.parametrize("languages", [1, 2, 5])
def test_what_the_pipeline_keeps_hangs_on_the_text_alone(spark, languages):
    rnd = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rnd.choices(letters, k=rnd.randint(2, 8))) for _ in range(60)]
    text = lambda n: " ".join(rnd.choices(words, k=n))
    # languages of one vocabulary: their models are so close that no score is far from 1 / languages
    rows = [(i, text(60), f"l{i % languages}") for i in range(200 * languages)]
    clean = [(10_000 + i, text(n), None) for i, n in enumerate([3, 8, 20, 60, 200] * 4)]
    noise = [(20_000 + i, " ".join("".join(rnd.choices(letters, k=rnd.randint(2, 8))) for _ in range(80)), None) for i in range(20)]
    other = [(30_000, "123 456", None), (30_001, None, None)]
    docs = spark.createDataFrame([*rows, *clean, *noise, *other], SCHEMA + ", lang string")
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert kept == {r[0] for r in [*rows, *clean]}


def test_the_pipelines_model_and_limits_come_from_all_labelled_rows(spark, monkeypatch):
    monkeypatch.setattr(langid, "COUNTED", 500)  # tasks pass their counts on several times
    rnd = random.Random(6)
    words = {x: ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(2, 8))) for _ in range(300)] for x in "xy"}
    rows = [(i, " ".join(rnd.choices(words["xy"[i % 2]], k=rnd.randint(1, 6))), "xy"[i % 2]) for i in range(10_000)]
    docs = spark.createDataFrame(rows, SCHEMA + ", lang string").repartition(4)
    model = langid.fit(docs, sample_docs=None)
    (_, group), = model.groups
    for k, x in enumerate(model.languages):
        data, offsets = langid.folded(*common.text_bytes(pa.array([t for _, t, y in rows if y == x])))
        want = langid.Statistics(*np.unique(langid.codes(group.symbol[data], offsets), return_counts=True))
        assert (group.statistics[k].code == want.code).all() and (group.statistics[k].seen == want.seen).all()
    half = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(2))
    held = docs.where(half == 1).collect()
    found = langid.fit(docs.where(half == 0), sample_docs=None).predict(pa.array([r["text"] for r in held])).to_pylist()
    limits = langid.limits(docs)
    for x in "xy":
        own = [p for r, p in zip(held, found, strict=True) if r["lang"] == p["lang"] == x]
        assert len(own) > langid.SAMPLE_DOCS
        bits, symbols = (np.array([p[c] for p in own], float) for c in ("bits", "symbols"))
        usual = np.median(bits / symbols)
        most = np.quantile((bits / symbols - usual) * np.sqrt(symbols / (1 + symbols / langid.STEADY)), langid.QUANTILE)
        assert np.allclose(limits[x], (usual, langid.SLACK * most), rtol=1e-9)


def test_quantiles_are_percentiles(spark):
    rnd = random.Random(3)
    rows = [(x, v) for x, n in (("a", 1), ("b", 2), ("c", 1000), ("d", 7)) for v in (rnd.choice([rnd.gauss(0, 5), 0.25]) for _ in range(n))]
    df = spark.createDataFrame(rows, "lang string, v double").repartition(3)
    for q in (0.0, 0.5, 0.999, 1.0):
        want = {r[0]: r[1] for r in df.groupBy("lang").agg(F.percentile("v", q)).collect()}
        assert {r[0]: r[1] for r in langid.quantile(df, F.col("v"), q, "v").collect()} == pytest.approx(want, rel=1e-12)
    assert langid.quantile(df.limit(0), F.col("v"), 0.5, "v").count() == 0


def test_language_edge_cases(spark):
    rows = [(1, "the cat sat on the mat and the dog", "en"), (2, "der Hund und die Katze sind auf der Matte", "de"), (3, None, "en"), (4, "gar nichts", None)] * 3
    train = spark.createDataFrame(rows, SCHEMA + ", lang string")
    model = langid.fit(train)
    assert model.languages == ["de", "en"]
    docs = spark.createDataFrame([(1, "THE DOG AND THE CAT"), (2, "und der Hund"), (3, None), (4, "123 !!"), (5, ""), (5, ""), (6, "½ ² 3")], SCHEMA).withColumn("language", F.lit(1))
    out, name = langid.predict(docs, model)
    got = sorted((r["doc_id"], r[name]["lang"], r[name]["score"] > 0) for r in out.collect())
    assert got == [(1, "en", True), (2, "de", True), (3, "und", False), (4, "und", False), (5, "und", False), (5, "und", False), (6, "und", False)]
    empty, name = langid.predict(docs, langid.fit(train.limit(0)))
    assert {r[name]["lang"] for r in empty.collect()} == {"und"}
    assert langid.predict(docs.limit(0), model)[0].count() == 0


# ------------------------------------------------------------------------------- op 4

def test_secret_patterns(spark):
    texts = {1: 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', 2: "PassWord:abcdefghijkl é API_KEY='short'", 3: "x AKIA" + "A1" * 7 + " AKIASHORT",
             4: None, 5: "", 6: "ſecret=abcdefghijklmn toKen=abcdefghijklmn", 7: "é" * 5 + "0123456789abcdef0 0123456789abcde", 8: "token: secret : abcdefghijklmnop"}
    out, name = secrets.find_secrets(spark.createDataFrame(list(texts.items()), SCHEMA))
    got = {r["doc_id"]: r[name] for r in out.collect()}
    assert got[1]["base"] == "assign:0:49,hex:9:49" and "entropy:9:49" in got[1]["spans"]
    assert got[2]["base"] == "assign:0:21"
    assert got[3]["base"] == "access:2:20"
    assert got[4]["spans"] == got[5]["spans"] == ""
    assert got[6]["base"] == "assign:22:42"          # only A-Z and a-z count as either case
    assert got[7]["base"] == "hex:5:22"              # code points; 15 characters are too few
    assert got[8]["base"] == ""                      # the failing match has taken the keyword


def test_entropy_windows_equal_brute_force():
    rnd = random.Random(2)
    for _ in range(60):
        text = "".join(rnd.choice(rnd.choice(["ab", "abcdefgh", "0123456789abcdefghijklmnopqrstuvwxyzABCD"])) for _ in range(rnd.randint(24, 80)))
        least = rnd.choice([2.0, 3.0, 3.5])
        hit = set()
        for k in range(len(text) - secrets.WINDOW + 1):
            part = text[k:k + secrets.WINDOW]
            h = -sum(part.count(c) / secrets.WINDOW * log2(part.count(c) / secrets.WINDOW) for c in set(part))
            if h >= least - 1e-12:
                hit.update(range(k, k + secrets.WINDOW))
        assert {i for a, b in secrets.entropy_runs(text, least) for i in range(a, b)} == hit


def test_allow_list_and_classes():
    s = secrets.Scanner()
    assert s.entropy_spans("123e4567-e89b-12d3-a456-426614174000") == []
    assert s.entropy_spans("1" * 40 + " " + "4785380592391140" * 3) == []           # digits are no secret
    assert s.entropy_spans("antidisestablishmentarianismandsoon") == []
    assert s.entropy_spans("x wJalrXUtnFEMIK7MDENGbPxRfiCYzK3k9Q x") == [(2, 3, 36)]
    assert secrets.Scanner(allow=["wJalr.*"]).entropy_spans("wJalrXUtnFEMIK7MDENGbPxRfiCYzK3k9Q") == []


# ------------------------------------------------------------------------------- op 5

def plain_fingerprint(text: str) -> int:
    w, o = common.word_hashes(*common.text_bytes(pa.array([text])))
    terms = common.shingle_hashes(w, o, 2)[0].tolist()
    votes = [sum(1 if h >> k & 1 else -1 for h in terms) for k in range(64)]
    return sum(1 << k for k in range(64) if votes[k] > 0)


def test_fingerprints_and_next_documents(spark):
    rnd = random.Random(4)
    docs = [(i * 3, " ".join(rnd.choice(["été", "of", "the", "x", "yy"]) for _ in range(rnd.randint(0, 900)))) for i in range(60)]
    docs += [(200, None), (201, ""), (201, ""), (None, "null id"), (202, "one")]
    got = fingerprint.with_next(spark.createDataFrame(docs, SCHEMA).repartition(5)).collect()
    order = sorted(((-2**63 if d is None else d), t or "") for d, t in docs)
    want = []
    for k, (d, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        e = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        f, g, h = plain_fingerprint(t), plain_fingerprint(e), plain_fingerprint(after)
        want.append((None if d == -2**63 else d, len(t), hashlib.sha256(e.encode()).hexdigest(), f"{f:016x}", f"{g:016x}",
                     1 - (f ^ g).bit_count() / 64, 1 - (f ^ h).bit_count() / 64))
    assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(want, key=str)
    one = fingerprint.with_next(spark.createDataFrame([(1, "a b c d")], SCHEMA)).first()
    assert one["edited_sha256"] == hashlib.sha256(b"a b a b").hexdigest() and one["near_next"] == 1.0
    assert fingerprint.with_next(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rows_without_an_id_are_many_ranges(spark):
    rnd = random.Random(6)
    docs = [(None if k % 2 else k, " ".join(rnd.choice("abcdefgh") * 3 for _ in range(30)), "clash") for k in range(2000)]
    got = fingerprint.with_next(spark.createDataFrame(docs, SCHEMA + ", key string"))
    sizes = got.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    assert sum(sizes) == 2000 and max(sizes) < 700 and sum(n > 0 for n in sizes) >= 6


def test_all_fingerprints_within_the_radius(spark):
    rnd = random.Random(8)
    base = [rnd.getrandbits(64) for _ in range(20)]
    prints = base + [b ^ sum(1 << k for k in rnd.sample(range(64), rnd.randint(0, 6))) for b in base for _ in range(15)]
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    df = spark.createDataFrame(list(enumerate(signed)), "doc_id long, bits long")
    got = {r["bits"]: r["n_within"] for r in fingerprint.within(df, df.where("doc_id % 10 = 0")).collect()}
    want = {signed[i]: sum((prints[i] ^ p).bit_count() <= 3 for p in prints) for i in range(0, len(prints), 10)}
    assert got == want

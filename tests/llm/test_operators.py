"""Training-data operators against plain Python on small tables with hard rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from wellspring.llm import (
    dedup_passages,
    language_model,
    languages,
    leaks,
    near_documents,
    near_vectors,
    packing,
    personal_data,
    sharding,
    toxicity,
)
from wellspring.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
PASSAGE = " ".join(f"shared{i}" for i in range(50))
STORY = "the quick brown fox jumps over the lazy dog and runs far away from the old house today "
#: Nulls, blanks, repeats, near copies, a very long text and odd white space.
HARD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, STORY * 3), (6, STORY * 3),
    (7, STORY * 3 + "again"), (8, f"before {PASSAGE} after"), (9, f"other {PASSAGE} end"),
    (10, "x y " * 60), (11, "w" * 50_000 + " tail"), (12, "a\x0bb\x0cc\rd  e"), (13, "ONE"),
    (14, "Über straße   日本 語"), (15, "mail me.a@b.co.uk or +1 (234) 555-6789, 4111 1111 1111 1111"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"id{i}", 7) for i, t in HARD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, id string, band int")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_passages(docs, empty):
    rows = {r.doc_id: r for r in dedup_passages.remove_repeats(docs).collect()}
    texts = {i: WORD.findall(t or "") for i, t in HARD}
    seen = Counter(tuple(w[k : k + 35]) for w in texts.values() for k in range(len(w) - 34))
    for i, w in texts.items():
        gone = {
            k + j
            for k in range(len(w) - 34)
            if seen[tuple(w[k : k + 35])] > 1
            for j in range(35)
        }
        assert rows[i].n_words == len(w) and rows[i].n_removed == len(gone)
        assert rows[i].kept == " ".join(x for k, x in enumerate(w) if k not in gone)
    assert rows[8].kept == "before after" and rows[10].n_removed == 120
    assert dedup_passages.remove_repeats(empty).count() == 0


def _sets(width):
    out = {}
    for i, t in HARD:
        w = WORD.findall((t or "").translate(LOWER))
        full = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}
        out[i] = full or ({tuple(w)} if w else set())
    return out


def test_near_documents(docs, empty):
    got = {r.doc_id: r for r in near_documents.near_duplicates(docs, width=4).collect()}
    sets, parent = _sets(4), {i: i for i, _ in HARD}
    for _ in HARD:
        for a, x in sets.items():
            for b, y in sets.items():
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    parent[a] = parent[b] = min(parent[a], parent[b])
    for i, s in sets.items():
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(s), parent[i], parent[i] == i)
    assert near_documents.near_duplicates(empty).count() == 0


def test_near_copies_of_an_original_of_middle_id(spark):
    original = [f"w{k}" for k in range(100)]
    rows = [(500, " ".join(original))]
    for k in range(1001):
        if k != 500:
            copy = list(original)
            for j, at in enumerate((5 + k % 43, 53 + k // 43 % 42)):
                copy[at] = f"changed{k}x{j}"
            rows.append((k, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_documents.near_duplicates(df, width=4).collect()
    assert len(got) == 1001 and {r.component_id for r in got} == {0}


def test_pairs_of_large_buckets_are_all_compared(spark, monkeypatch):
    rng = np.random.default_rng(4)
    members = [(7, i, 50, *rng.integers(0, 2**62, 4).tolist(), i // 5) for i in range(90)]
    members += [(7, 90 + i, 50, *members[i][3:7], 100 + i) for i in range(0, 90, 3)]
    frame = spark.createDataFrame(
        members, "band long, id long, n long, b0 long, b1 long, b2 long, b3 long, c long"
    )
    monkeypatch.setattr(near_documents, "CHUNK", 16)
    pairs = {(r.a, r.b) for r in near_documents._remaining_pairs(frame, 80).collect()}
    assert pairs == {(90 + i, i) for i in range(0, 90, 3)}


def test_large_buckets_are_compared_on_their_sets(spark, monkeypatch):
    """Equal signatures, but sets that reach the bound only for the pairs (60 + i, i)."""
    rng = np.random.default_rng(5)
    sets = [rng.integers(0, 2**63, 20, dtype=np.uint64) for _ in range(60)]
    sets += [np.r_[x[: 18 if i % 2 else 17], rng.integers(0, 2**63, 2 + (i % 2 == 0), dtype=np.uint64)] for i, x in enumerate(sets)]
    frame = spark.createDataFrame(
        [(7, i, 20, 1, 2, 3, 4, i) for i in range(120)],
        "band long, id long, n long, b0 long, b1 long, b2 long, b3 long, c long",
    )
    held = spark.createDataFrame([(i, np.sort(x).tobytes()) for i, x in enumerate(sets)], "id long, hashes binary")
    monkeypatch.setattr(near_documents, "CHUNK", 16)
    pairs = {(r.a, r.b) for r in near_documents._remaining_pairs(frame, 80, held).collect()}
    assert pairs == {(60 + i, i) for i in range(1, 60, 2)}


def test_pipeline_stages_pass_small_batches(spark, tmp_path):
    import corpus_pipeline

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        docs = spark.createDataFrame([(1, "some words of a text", "en")], "doc_id long, text string, lang string")
        assert corpus_pipeline.language(spark, docs, str(tmp_path)).count() == 1
        assert int(spark.conf.get(name)) <= 1000
    finally:
        spark.conf.set(name, before)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_pipeline_stages_leave_texts_where_they_are(spark, tmp_path, monkeypatch, limit):
    """Few ids go to the texts; repeated and null ids are kept or dropped as by joins on the id."""
    import corpus_pipeline
    from wellspring.llm import stages

    monkeypatch.setattr(stages, "BROADCAST_ROWS", limit)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    item = " ".join(f"item{k}" for k in range(40))
    mail = "write to anna@example.org for zebras"
    rows = [(1, STORY * 3), (2, STORY * 3), (3, item), (None, item), (None, STORY), (4, mail), (4, "plain"), (5, "other words")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = lambda df: sorted((r.doc_id or 0, r.text) for r in df.collect())
    try:
        near = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
        clean = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
        hidden = corpus_pipeline.personal(spark, docs, str(tmp_path))
    finally:
        spark.conf.set(batch, before)
    assert near.columns == clean.columns == hidden.columns == docs.columns
    assert found(near) == sorted(r for r in rows if r[0] not in (2, None))
    assert found(clean) == sorted((i or 0, t) for i, t in rows if i != 3)
    own = [t for i, t in found(hidden) if i == 4]
    assert len(own) == 2 and "anna@" not in "".join(own) and "[EMAIL]" in own[1]
    assert [r for r in found(hidden) if r[0] != 4] == sorted((i or 0, t) for i, t in rows if i != 4)
    if limit:
        assert "hashpartitioning" not in _plan(near) + _plan(clean)


def test_terms_are_counted_before_they_are_shuffled(spark):
    docs = spark.createDataFrame([("alpha beta alpha",), ("beta gamma",), (None,), ("",)], "text string")
    terms = spark.createDataFrame([("beta",), ("gamma",), ("delta",)], "term string")
    got = personal_data.texts_with(docs, terms, "text")
    assert {r.term: r.n for r in got.collect()} == {"beta": 2, "gamma": 1}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")


def test_signatures_travel_only_for_mixed_buckets(spark):
    """Buckets of one component leave; the members of the others have their component."""
    members = spark.createDataFrame(
        [(1, 10, 5), (1, 11, 5), (2, 10, 5), (2, 12, 5), (3, None, 5)], "band long, id long, n long"
    )
    labels = spark.createDataFrame([(10, 10), (11, 10)], "node long, component long")
    got = near_documents._mixed(members, labels)
    assert got.columns == ["band", "id", "n", "c"]
    assert sorted(map(tuple, got.collect())) == [(2, 10, 5, 10), (2, 12, 5, 12)]


def test_densified_bins_agree_as_often_as_the_sets():
    rng = np.random.default_rng(0)
    for size, common in ((10, 9), (200, 180)):
        agree = []
        for _ in range(40):
            pool = rng.integers(0, 2**63, size + (size - common), dtype=np.uint64)
            a, b = np.sort(pool[:size]), np.sort(np.r_[pool[:common], pool[size:]])
            rows = np.repeat([0, 1], [len(a), len(b)])
            s = near_documents.bins_of(rows, np.r_[a, b], 2)
            agree.append((s[0] == s[1]).mean())
        assert abs(np.mean(agree) - common / (2 * size - common)) < 0.06


def test_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (9, 8), (8, 8), (None, 1), (2, 5)], "a int, b int")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {2: 2, 3: 2, 4: 2, 5: 2, 8: 8, 9: 8}
    assert components(links.limit(0)).count() == 0


def test_near_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((30, 16))
    rows = []
    for k in range(120):
        v = base[k % 30] + 0.08 * rng.standard_normal(16) * (k // 30)
        rows.append((k, v.tolist(), k % 3, "x"))
    rows += [(200, rows[0][1], 0, "x"), (201, rows[0][1], 1, "x"), (202, rows[0][1], None, "x")]
    rows += [(203, None, 0, "x"), (204, [], 0, "x"), (205, [0.0] * 16, 0, "x"), (208, [1.0], 0, "x")]
    rows += [(206, [float("nan")] + [1.0] * 15, 0, "x"), (207, [None] + [1.0] * 15, 0, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, block string")
    got = {r.vec_id: r for r in near_vectors.near_vectors(df).collect()}
    good = {r[0]: (np.array(r[1]), r[2]) for r in rows if r[0] < 202}
    links, parent = Counter(), {r[0]: r[0] for r in rows}
    pairs = [
        (a, b)
        for a, (x, lx) in good.items()
        for b, (y, ly) in good.items()
        if a < b and lx == ly and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93
    ]
    for _ in rows:
        for a, b in pairs:
            parent[a] = parent[b] = min(parent[a], parent[b])
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    assert pairs and len(got) == len(rows)
    for k, r in got.items():
        assert (r.n_links, r.component_id, r.kept) == (links[k], parent[k], parent[k] == k)
    assert near_vectors.near_vectors(df.limit(0)).count() == 0


def _luhn(value):
    total = 0
    for i, c in enumerate(reversed([c for c in value if c.isdigit()])):
        n = int(c)
        total += n * 2 - 9 * (n > 4) if i % 2 else n
    return total % 10 == 0


def _base_spans(text):
    digits = lambda v: sum(c in "0123456789" for c in v)
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= digits(v) <= 19 and _luhn(v)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= digits(v) <= 15),
    )
    return [
        (kind, m.start(), m.end()) for kind, rx, ok in kinds for m in re.finditer(rx, text) if ok(m[0])
    ]


def test_pattern_spans(spark, docs, empty):
    rng = np.random.default_rng(3)
    bits = ["a.b@c.d.e", "@", ".", "..", "a-b", "x_y@q.r", "1.2.3.4", "256.1.1.1", "+1 (2) 345-6789",
            "4111 1111 1111 1111", "4111-1111-1111-1111", "  ", "-", " ", "5", "12", "é", "日本", "%", "+4",
            "a@b.com_x@c.org", "4111111111111111", "000000001.2.3.4"]
    rows = [(k, "".join(rng.choice(bits, rng.integers(0, 25)))) for k in range(400)]
    rows += [(1000, "1 " * 20_000), (1001, "a@b" + ".c" * 20_000), (1002, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in personal_data.digest(personal_data.all_spans(df)).collect()}
    for k, text in rows:
        want = ",".join(f"{n}:{a}:{b}" for n, a, b in _base_spans(text or ""))
        assert got[k].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), text
        assert got[k].n_card == want.count("card:") and got[k].n_phone == want.count("phone:")
    assert personal_data.all_spans(empty).count() == 0
    clean = {r.doc_id: r.text for r in personal_data.sanitised(docs).collect()}
    assert clean[15] == "mail [EMAIL] or [PHONE], [CARD]" and clean[1] is None and clean[5] == STORY * 3
    assert personal_data.sanitised(docs).columns == docs.columns


def test_disclosing_terms(spark):
    rows = [(k, f"case {'abcdefgh'[k]}: the zorkish gardener writes from me@x.org every day") for k in range(6)]
    rows += [(100 + k, "every day the gardener writes to all of us in the town " * 3) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.terms for r in personal_data.all_spans(df).collect()}
    texts = dict(rows)
    terms = {texts[k][s.start : s.end] for k, spans in got.items() for s in spans}
    assert "zorkish" in terms and "the" not in terms and "every" not in terms
    assert not any(got[k] for k in got if k >= 100)


def test_terms_of_rare_entities_are_marked_everywhere(spark):
    far = "every day the town writes to all of us " * 20
    rows = [(1, f"Zorkish {far} me@x.org and {far} then zorkish again"), (2, f"we call 1@y.org or {far}")]
    rows += [(3, rows[0][1])] + [(10 + k, f"we call and then again {far} {'abcd'[k % 4]}{k}") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.terms] for r in personal_data.all_spans(df).collect()}
    text = rows[0][1]
    assert got[1] == got[3] == [(m.start(), m.end()) for m in re.finditer("(?i)zorkish", text)]
    assert {rows[1][1][a:b] for a, b in got[2]} == set()


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(packing.default_vocabulary())
    exact.encode_special_tokens = True
    ids = {
        i: np.array(exact.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4") for i, t in HARD
    }
    rows = packing.pack(docs, capacity=64).collect()
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for i, own in ids.items():
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            part = own[r.start : r.start + r.length]
            assert r.start == at and r.doc_tokens == len(own) and zlib.crc32(part.tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(own)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert packing.pack(empty).count() == 0


def test_cutting_stock_is_close_to_its_bound():
    sizes = np.arange(1, 65)
    counts = np.random.default_rng(1).integers(50, 400, 64).astype(float)
    patterns = packing.cutting_stock(sizes, counts, 64)
    used = sum(p * n for p, n in patterns)
    assert np.allclose(used, counts, rtol=1e-5)
    assert sum(n for _, n in patterns) <= 1.03 * (sizes * counts).sum() / 64
    whole = packing.rounded(patterns, sizes, counts, 64)
    assert (sum(p * n for p, n in whole) <= counts).all()


def test_languages(spark, docs, empty, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = languages.identify(table).join(table.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 20 and np.mean([r.lang_pred == r.lang for r in held]) >= 0.95
    odd = {r.doc_id: r for r in languages.identify(docs).collect()}
    assert odd[1].lang_pred == odd[2].lang_pred == "und" and odd[1].score == 0
    assert odd[5].lang_pred == "en" and 0 <= odd[5].score <= 1
    model = languages.learned(languages.training(table))
    texts = {r.lang: r.text for r in table.where("n_chars between 800 and 3000").collect()}
    mixed = model.predict(texts["de"] + " " + texts["fr"])[2]
    assert set(mixed) == {"de", "fr"}
    assert languages.determined(docs, model).count() == len(HARD) - 3
    assert languages.identify(empty).count() == 0


def test_leaks(spark, empty):
    item = "Which river runs through the old town near the northern gate of the city. The answer is the silver river of course"
    near = item.replace("silver", "golden")
    rows = [(1, f"noise {item} noise"), (2, "noise words only here " * 30), (3, None), (4, ""), (5, item.upper()),
            (6, "filler text " * 400 + item), (7, item[:60])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("x", "score")
    items = spark.createDataFrame([(10, item), (11, near), (12, None), (13, " "), (14, item)], "item_id int, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.leaks(df, items).collect()}
    assert {(d, i) for d, i in got if i in (10, 14)} == {(d, i) for d in (1, 5, 6) for i in (10, 14)}
    assert {r.doc_id for r in leaks.without_leaks(df, items).collect()} == {2, 3, 4, 7}
    assert leaks.leaks(empty, items).count() == 0 and leaks.leaks(df, items.limit(0)).count() == 0


def test_leaks_of_question_and_answer_apart(spark, monkeypatch):
    question, answer = ("what" + " is%d" * 11 % tuple(range(11)), "it is " + "so%d " * 6 % tuple(range(6)))
    items = [(1, f"{question}.\n{answer.strip()}")]
    items += [(k, " ".join(f"other{k}x{j}" for j in range(20))) for k in range(2, 8)]
    items = spark.createDataFrame(items, "item_id long, text string")
    gap = " ".join(f"gap{j}" for j in range(500))
    texts = [
        f"{question}. Answer: {answer}", f"{answer} {gap} {question}. {gap}", f"{question}. {gap}", f"{gap} {answer}",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for size in (leaks.ITEMS, 2):
        monkeypatch.setattr(leaks, "ITEMS", size)
        got = {r.doc_id: r for r in leaks.leaks(df, items).collect()}
        assert set(got) == {0, 1} and all(r.item_id == 1 for r in got.values())
        assert all(r.question_overlap == r.answer_overlap == 1 for r in got.values())
        scores = {k: r.score for k, r in got.items()}
        assert size != 2 or scores == pytest.approx(whole)
        whole = scores


def test_language_model(docs, empty):
    got = {r.doc_id: r for r in language_model.scores(docs).collect()}
    texts = {i: [*WORD.findall((t or "").translate(LOWER)), None] for i, t in HARD}
    c = Counter(w for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    n, v = sum(c.values()), len(c)
    for i, t in texts.items():
        base = sum(math.log10((c[w] + 1) / (n + 1 * (v + 1))) for w in t)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(got[i].base_score, base, rel_tol=1e-9) and got[i].score < 0
    assert language_model.scores(empty).count() == 0


def test_all_training_texts_shape_the_scores(spark):
    m = language_model
    rng = np.random.default_rng(6)
    texts = {k: rng.integers(0, 40, 30) for k in range(20)} | {77: np.tile([7, 9], m.TEXT_IDS)}
    rows = spark.createDataFrame(
        [(k, bytearray(t.astype("<u2").tobytes())) for k, t in texts.items()], "id long, ids binary"
    )
    model = m.Attention(m.id_counts(rows))
    counts = m.following_counts(rows, model.group)
    want = Counter()
    for t in texts.values():
        want.update(zip([m.VOCABULARY - 1, *t[:-1].tolist()], model.group[t].tolist()))
    assert {(i, c): counts[i, c] for i, c in zip(*map(np.ndarray.tolist, np.nonzero(counts)))} == want
    before = model.log10([np.array([7, 9] * 5)])[0]
    model.follow(counts)
    assert model.log10([np.array([7, 9] * 5)])[0] > before + 1
    pieces = rows.select("id", m._piece(rows["ids"]).alias("ids")).collect()
    assert all(bytes(r.ids) in texts[r.id].astype("<u2").tobytes() for r in pieces)
    assert {r.id: len(r.ids) for r in pieces}[77] == 2 * m.TEXT_IDS and len(pieces) == 21


def test_readout_learns_from_every_window_of_every_training_text(spark):
    m = language_model
    rng = np.random.default_rng(8)
    # more texts than any sample held, one of them long; what follows 5 is told by the id before it
    texts = [np.array([a, 5, a + 10] * 6) for a in rng.integers(20, 24, 1_800)]
    texts.append(np.tile([7, 9, 11, 9], 2_000))
    rows = spark.createDataFrame(
        [(k, bytearray(t.astype("<u2").tobytes())) for k, t in enumerate(texts)], "id long, ids binary"
    ).repartition(5)
    model = m.Attention(m.id_counts(rows))
    counts = m.following_counts(rows, model.group)
    model.follow(counts)
    model.embed(counts)
    sums = m.readout_sums(rows, model)
    assert np.allclose(sums, model.sums(texts), atol=1e-2)
    assert np.array_equal(sums, m.readout_sums(rows, model))
    some = [texts[0], texts[1], texts[-1][:300]]
    model.p["out"] *= 0
    before = model.log10(some).sum()
    model.read_out(counts, sums)
    assert model.log10(some).sum() > before


#: Cuts of all kinds, and white space beyond ASCII, after which there must be none.
ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "  two  blanks \t and\ttabs\r\n end \n", "don't we'll 'tis ''s 's3 x'RE '", "3rd 12ab34 5.6,7 a1-b2",
    "\u00e9t\u00e9\u00e7### ou\u00e9, na\u00efve's", "cut\u00a0 here \u00a0x\u2003 \u3000 y\u0085\nz", "nbsp\u00a0at end\u00a0", "e\u0301 \u65e5\u672c \u8a9e1\u00bd \U0001f600!",
    "\x00\x1c\x1f a\x7fb _under_score_", "Zealously unprecedentedantidisestablishmentarianismfloccinaucinihilipilification", "w" * 3_000 + " " * 70 + "tail",
]


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_ids_by_pieces_are_those_of_the_whole_texts(bits):
    m = language_model
    vocabulary = m.default_vocabulary()
    encode = packing.encoder(vocabulary)
    rng = np.random.default_rng(5)
    mixed = ["".join(rng.choice(list("aB3'. \n\u00e9\u00a0-"), 40)) for _ in range(300)]
    want = [[*encode((t or "").translate(LOWER)), m.VOCABULARY - 1] for t in ODD_TEXTS + mixed]
    table = m.Pieces(vocabulary, bits)
    for limit in (1, 60, 1 << 18):
        got = []
        for part in m.slices(pa.array(ODD_TEXTS + mixed, pa.string()), limit):
            ids, size = table.of(part)
            assert len(size) == part.rows and size.sum() == len(ids)
            got += [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])]
        assert got == want


def test_pieces_that_recur_are_not_encoded_again(monkeypatch):
    m = language_model
    encoded = []
    real = packing.encoder(m.default_vocabulary())
    monkeypatch.setattr(m, "encoder", lambda vocabulary: lambda text: (encoded.append(text), real(text))[1])
    table = m.Pieces(m.default_vocabulary())
    once, again = (list(m.slices(pa.array([t] * n)))[0] for t, n in ((STORY, 1), (STORY * 9 + "unheard", 50)))
    table.of(once)
    encoded.clear()
    ids, size = table.of(again)
    assert [t for t in encoded if t] == [" unheard"] and len(size) == 50
    assert ids[: size[0] - 1].tolist() == real(STORY * 9 + "unheard").tolist()


@pytest.mark.parametrize("size", [1, 40])
def test_attention_sums_equal_those_of_states(size):
    m = language_model
    rng = np.random.default_rng(10)
    model = m.Attention(rng.integers(0, 50, m.VOCABULARY))
    model.p["embed"] *= size
    assert model.near().safe == (size == 1)
    texts = [rng.integers(0, 300, n) for n in (1, 23, 24, 45, 5_000, 2)]
    every, before, at, _, fresh = model.windows(texts)
    h = model.states(before[at])[-1][fresh].astype(np.float64)
    by_id, by_class = np.zeros((m.VOCABULARY, m.DIMS)), np.zeros((m.CLASSES, m.DIMS))
    np.add.at(by_id, before[at][fresh], h)
    np.add.at(by_class, model.group[every[at][fresh]], h)
    want = np.concatenate((by_id.ravel(), by_class.ravel(), (h.T @ h).ravel()))
    assert np.allclose(model.sums(texts), want, atol=2e-3)


@pytest.mark.parametrize("frequent", [0, 3, 1 << 16])
def test_frequent_words_stay_in_the_tasks(spark, docs, monkeypatch, frequent):
    m = language_model
    texts = {i: [*WORD.findall((t or "").translate(LOWER)), None] for i, t in HARD}
    c = Counter(w for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    n, v = sum(c.values()), len(c)
    train = docs.where("doc_id is not null and pmod(crc32(cast(doc_id as string)), 7) <> 2")
    known = m.training_words(train, "text")
    assert sorted(r.c for r in known.collect()) == sorted(c.values())
    table = m.most_frequent(known, frequent)
    chosen = table.column("c").to_pylist()
    assert chosen == sorted(c.values(), reverse=True)[: len(chosen)] and len(chosen) <= frequent
    assert frequent < v or len(chosen) == v
    rows = m.word_counts(docs, "doc_id", "text", table).collect()
    held = {r.word for r in table.to_pandas().itertuples()}
    assert len([r for r in rows if r.part is not None]) == len(HARD)
    assert not held & {r.word for r in rows if r.part is None}
    assert sum(r.n for r in rows) == sum(map(len, texts.values()))
    monkeypatch.setattr(m, "FREQUENT", frequent)
    for r in m.base_scores(docs, "doc_id", "text", 7, 2).collect():
        own = texts[r.id]
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(c[w] > 0 for w in own), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)


@pytest.mark.parametrize("size", [1, 40])
def test_fast_scores_equal_those_of_forward(size):
    """Also with weights so large that exponents must be shifted."""
    m = language_model
    rng = np.random.default_rng(9)
    model = m.Attention(rng.integers(0, 50, m.VOCABULARY))
    model.follow(rng.integers(0, 3, (m.VOCABULARY, m.CLASSES)))
    model.p["embed"] *= size
    model.p["out"] *= size
    texts = [rng.integers(0, m.VOCABULARY, n) for n in (1, 24, 700)]
    every, before, at, owner, fresh = model.windows(texts)
    assert np.allclose(model.outputs(before[at]), model.states(before[at])[-1], atol=1e-4)
    logits = model.forward(before[at]).astype(np.float64)
    logs = logits - logits.max(axis=2, keepdims=True)
    logs -= np.log(np.exp(logs).sum(axis=2, keepdims=True))
    own = np.take_along_axis(logs, model.group[every[at]][..., None], 2)[..., 0] / np.log(10)
    want = np.bincount(owner, (own * fresh).sum(axis=1), 3) + [model.within[t].sum() for t in texts]
    assert np.allclose(model.log10(texts), want, rtol=1e-4)


def test_attention_sums_to_one_and_sees_no_later_id():
    model = language_model.Attention(np.arange(language_model.VOCABULARY) % 7)
    ids = np.random.default_rng(0).integers(0, 1000, (2, language_model.WINDOW))
    logits = model.forward(ids)
    other = ids.copy()
    other[:, -1] = 5
    assert np.allclose(logits[:, :-1], model.forward(other)[:, :-1], atol=1e-5)
    share = np.exp(logits[0, 3] - logits[0, 3].max())
    share /= share.sum()
    assert math.isclose((share[model.group] * 10.0**model.within).sum(), 1, rel_tol=1e-3)


def test_attention_gradients():
    model = language_model.Attention(np.ones(language_model.VOCABULARY, dtype=np.int64))
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 50, (3, language_model.WINDOW))
    target = rng.integers(0, language_model.CLASSES, ids.shape)
    there = np.ones(ids.shape, bool)

    def loss():
        logits = model.forward(ids).astype(np.float64)
        logs = logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))
        return -np.take_along_axis(logs, target[..., None], 2).mean()

    g = model.fit(ids, target, there)
    for name, at in (("qkv", (1, 9)), ("mix", (2, 3)), ("place", (4, 1)), ("out", (0, 5))):
        old = model.p[name][at]
        model.p[name][at] = old + 1e-2
        up = loss()
        model.p[name][at] = old - 1e-2
        down = loss()
        model.p[name][at] = old
        assert math.isclose((up - down) / 2e-2, g[name][at], rel_tol=0.05, abs_tol=1e-4)


def test_gradients_of_texts_are_those_of_their_windows():
    """Also with weights so large that exponents must be shifted."""
    m = language_model
    rng = np.random.default_rng(12)
    texts = [rng.integers(0, 300, n) for n in (1, 23, 24, 45, 3_000, 2)]
    for size in (1, 40):
        model = m.Attention(rng.integers(0, 50, m.VOCABULARY))
        model.follow(rng.integers(0, 3, (m.VOCABULARY, m.CLASSES)))
        model.p["embed"] *= size
        model.p["out"] *= size
        assert (model.near().safe, model.small()) == (size == 1, size == 1)
        every, before, at, _, fresh = model.windows(texts)
        g = model.fit(before[at], model.group[every[at]], fresh)
        want = np.concatenate([g[name].ravel() for name in model.p]) * len(every)
        assert np.allclose(model.gradients(texts), want, rtol=1e-3, atol=1e-2 * size)


def test_attention_learns_from_every_training_text(spark, monkeypatch):
    m = language_model
    rng = np.random.default_rng(13)
    # what follows 5 is told by the first id, some ids back; one text is long
    texts = [np.tile([a, *rng.integers(30, 40, 3), 5, a + 10], n) for a, n in zip(rng.integers(20, 24, 400), [60] + [8] * 399)]
    schema = "id long, ids binary"
    rows = spark.createDataFrame([(k, bytearray(t.astype("<u2").tobytes())) for k, t in enumerate(texts)], schema)
    own = [k for k in range(len(texts)) if zlib.crc32(str(k).encode()) % 7 != 2]
    seen, real = [], m.Attention.step
    monkeypatch.setattr(m.Attention, "step", lambda self, sums, n, *a: (seen.append(n), real(self, sums, n, *a)))
    got = {r.id: r.score for r in m.attention_scores(rows.repartition(3), 7, 2).collect()}
    assert len(seen) == m.ROUNDS and sum(seen) == sum(len(texts[k]) for k in own)
    again = {r.id: r.score for r in m.attention_scores(rows.repartition(1), 7, 2).collect()}
    assert got == pytest.approx(again, rel=1e-4) and len(got) == len(texts)
    monkeypatch.setattr(m, "learn", lambda *a: None)
    before = {r.id: r.score for r in m.attention_scores(rows, 7, 2).collect()}
    held = [k for k in got if k not in set(own)]
    assert sum(got[k] for k in held) > 0.97 * sum(before[k] for k in held)
    assert m.attention_scores(spark.createDataFrame([], schema), 7, 2).count() == 0


def test_sharding(docs, empty):
    got = sharding.shard(docs, 4).collect()
    groups = {}
    for i, t in HARD:
        groups.setdefault(hashlib.sha256((t or "").encode()).hexdigest(), []).append((i, len((t or "").encode()) + 1))
    sizes = [sum(s for _, s in groups[k]) for k in sorted(groups)]

    def need(limit):
        used, now = 1, 0
        for s in sizes:
            used, now = (used + 1, s) if now + s > limit else (used, now + s)
        return used

    best = next(c for c in range(max(sizes), sum(sizes) + 1) if need(c) <= 4)
    total, slot, of = Counter(), {}, {}
    for r in got:
        total[r.shard] += r.size
        slot.setdefault(r.shard, []).append(r.slot)
        of[r.doc_id] = r.shard
    assert max(total.values()) == best and all(sorted(s) == list(range(len(s))) for s in slot.values())
    assert all(len({of[i] for i, _ in g}) == 1 for g in groups.values())
    assert {r.doc_id: r.text_crc32 for r in got} == {i: zlib.crc32((t or "").encode()) for i, t in HARD}
    assert sharding.shard(empty, 4).count() == 0


def test_toxicity(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(toxicity, "WARM_EPOCHS", 4)
    rng = np.random.default_rng(4)
    names = [f"w{k}" for k in range(60)]
    rows, labels = [], []
    for k in range(400):
        own = list(rng.choice(names, 30))
        if k % 3 == 0:
            own[int(rng.integers(30))] = f"vilex{rng.integers(9)}"
        rows.append((k, " ".join(own)))
        labels.append((k, int(k % 3 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (0, 1), (1, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(df, marks).collect()
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == (r.doc_id % 3 == 0) for r in held]) >= 0.9
    odd = {r.doc_id: r.score for r in toxicity.toxicity(docs, marks.limit(0)).collect()}
    assert len(odd) == len(HARD) and all(0 <= s <= 1 for s in odd.values())
    assert toxicity.toxicity(empty, marks).count() == 0


def test_toxicity_gradients():
    net = toxicity.Network()
    rng = np.random.default_rng(2)
    drive = rng.standard_normal((3, toxicity.WINDOW, 6 * toxicity.HIDDEN)).astype(np.float32)
    there = np.ones(drive.shape[:2], bool)
    there[0, 10:] = False
    y = np.array([1.0, 0.0, 1.0], np.float32)

    def loss():
        p = toxicity.sigmoid(net.forward(drive, there).astype(np.float64))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    logits, kept = net.forward(drive, there, keep=True)
    g, d_drive = net.gradients(toxicity.sigmoid(logits) - y, kept, there)
    for values, grad, at in (
        (net.p["again"], g["again"], (1, 2, 20)), (net.p["focus"], g["focus"], (3,)),
        (drive, d_drive, (0, 4, 5)), (drive, d_drive, (1, 7, 40)),
    ):
        old = values[at]
        values[at] = old + 1e-2
        up = loss()
        values[at] = old - 1e-2
        down = loss()
        values[at] = old
        assert math.isclose((up - down) / 2e-2, grad[at], rel_tol=0.05, abs_tol=1e-3)


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns, name
        assert kept.select("doc_id").distinct().count() == kept.count() <= docs.count()
        docs = corpus_pipeline.saved(kept, name)
    assert not docs.where("text like '%.example.com%'").count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert pieces.select("doc_id").distinct().count() == docs.count()

"""The methods against plain definitions, the public libraries and held-out labels."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from notelake.llm import (
    byte_bpe, components, decontaminate, html_text, katz, near_dup, queries, quality, sharding,
    token_counts, toxicity,
)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


def odd_texts(seed):
    rng = random.Random(seed)
    words = ("the and 're 's 'll don't can't naïve éàü 123 !!! a'b internationalization aaaa 北京 "
             "привет <|endoftext|> ’s İ ΑΣ").split()
    for _ in range(200):
        if rng.random() < 0.5:
            yield "".join(rng.choice("etaoinshrdlu'.!1 éß\n\x85") for _ in range(rng.randint(0, 40)))
        else:
            glue = rng.choice(["", " ", "\n", "  "])
            yield glue.join(rng.choice(words) for _ in range(rng.randint(1, 12)))
    yield "a" * 5000 + "'" * 3000 + "12" * 50


def test_token_counts_are_the_library_s(texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, mine = Tokenizer.from_file(path), token_counts.Counter(path)
    for some in (list(texts.values()), list(odd_texts(1))):
        wanted = [len(e.ids) for e in library.encode_batch(some, add_special_tokens=False)]
        assert mine.count(some).tolist() == wanted
        mine.machine.forget()


def test_chunk_maps_compose():
    step, _ = token_counts.piece_machine()
    kinds = np.random.default_rng(0).integers(0, token_counts.CLASSES, (37, 11)).astype(np.uint8)
    state, wanted = 0, []
    for row in kinds:
        wanted.append(state)
        for kind in row:
            state = step[state, kind]
    assert token_counts.entry_states(kinds, step).tolist() == wanted


def test_byte_bpe_is_the_library_s(texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, mine = Tokenizer.from_file(path), byte_bpe.ByteBpe(path)
    for text in [*list(texts.values())[:60], *odd_texts(2)]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == ids
        assert mine.decode(mine.encode(text)) == library.decode(ids, skip_special_tokens=False)


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else
                                                                     set())


def test_near_duplicates_by_brute_force(spark, texts):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = dict(texts)
    for i in range(150):  # one large group of near copies, some of them too far from all
        words = [f"x{i}_{j}" if rng.random() < rng.choice([0.01, 0.02, 0.06]) else w
                 for j, w in enumerate(base)]
        rows[10_000 + i] = " ".join(words)
    sets = {i: shingles(t) for i, t in rows.items()}
    parent = {i: i for i in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    seen = collections.defaultdict(list)
    for i in sorted(rows):
        shared = collections.Counter(j for s in sets[i] for j in seen[s])
        for j, n in shared.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for s in sets[i]:
            seen[s].append(i)
    docs = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string")
    found = {r.doc_id: r for r in near_dup.near_duplicates(docs).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in found.items()} == {
        i: (len(sets[i]), root(i), root(i) == i) for i in rows}
    assert {r.doc_id for r in near_dup.keep_one(docs).collect()} == {
        i for i in rows if root(i) == i}


def test_one_of_each_without_proper_ids(spark):
    words = [f"w{i}" for i in range(200)]
    near = [" ".join([*words, f"x{i}"]) for i in range(6)]
    other = [t.replace("w", "v") for t in near]
    rows = [(None, t) for t in near] + [(3, t) for t in other[:3]] + [(4, other[3]), (None, other[4])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(str(r.doc_id) for r in near_dup.keep_one(docs).collect()) == ["3", "None"]


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 60, n).astype(np.uint64)) for n in (1, 2, 50, 3000)]
    half = np.concatenate([sets[3][:2000], rng.integers(0, 1 << 60, 1000).astype(np.uint64)])
    sketches = near_dup.sketch([*sets, half])
    assert (sketches < np.iinfo(np.uint64).max).all()
    same = (sketches[3] == sketches[4]).mean()
    assert abs(same - 0.5) < 0.2


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (95, 100), (7, 3)]
    found = components.connected_components(spark.createDataFrame(chain, "a bigint, b bigint"))
    wanted = {i: 0 for i in range(41)} | {i: 90 for i in (90, 95, 100)}
    assert {r.key: r.component for r in found.collect()} == wanted
    assert found.count() == len(wanted)


def test_word_rules_by_brute_force(spark, texts):
    found = {r.doc_id: r for r in quality.assess(
        spark.read.parquet(f"{SF}/documents.parquet"),
        public_tokenizers.path("piece_bpe_32k.model")).collect()}
    for i, text in texts.items():
        words = WORD.findall(text)
        windows = collections.Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
        inside = {j for k in range(len(words) - 4) if windows[tuple(words[k:k + 5])] > 1
                  for j in range(k, k + 5)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        row, failed = found[i], len(words) < 10 or 100 * len(inside) > 20 * len(words)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words,
                row.base_failed) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(inside), failed)
        assert not (row.kept and failed)


def test_quality_keeps_the_good(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    verdicts = quality.assess(docs, public_tokenizers.path("piece_bpe_32k.model"))
    rows = verdicts.where("not base_failed").join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.6 * len(bad)


def test_quality_judges_small_groups(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in quality.assess(
        docs, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    # No language has 50 documents of one octave here; these are labelled as bad.
    assert not any(rows[i].kept for i in (83, 140, 148, 154, 171))
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()
    good = [rows[r.doc_id].kept for r in labels if not rows[r.doc_id].base_failed]
    assert sum(good) >= 0.98 * len(good)


def test_every_group_has_a_band(spark):
    measures = "group string, n_tokens bigint, chars_per_token double, byte_share double, entropy double"
    usual = [("en", 200 + i, 2.2 + i % 7 / 100, 0.0, 6.3 + i % 5 / 50) for i in range(50)]
    rare = [("xx", 300, 2.2, 0.0, 6.3), ("xx", 301, 0.9, 0.6, 2.0), ("en", 90_000, 1.0, 0.5, 2.5),
            ("en", 90_001, 2.2, 0.0, 6.6)]
    table = quality.with_octave(spark.createDataFrame(usual + rare, measures)).withColumn(
        "base_failed", F.lit(False))
    judged = quality.judge(table, quality.bands(table, 4.5, 50))
    assert judged.where("least_chars is null").count() == 0
    bad = {(r.group, r.n_tokens) for r in judged.where("not kept").collect()}
    assert bad == {("xx", 301), ("en", 90_000)}


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).where("held_out").join(labels, "doc_id").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    toxic = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert sum(toxic) >= 0.75 * len(toxic) and sum(clean) <= 0.02 * len(clean)
    unseen = model.score(["what a stupidd thing", "utter trashh", "a lovely day"])
    assert (unseen[:2] > 0.5).all() and unseen[2] < 0.5


def distance(item, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        now = [i + 1]
        for j, d in enumerate(text):
            now.append(min(before[j] + (c != d), before[j + 1] + 1, now[j] + 1))
        before = now
    return min(before)


def test_decontamination_by_brute_force():
    rng = random.Random(1)
    items = [(i, "".join(rng.choice("abcdefgh  ") for _ in range(rng.choice([5, 22, 60, 100, 200]))))
             for i in range(20)]
    texts = []
    for _ in range(60):
        text = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, int(len(text) * 0.07) + 1)):
            at, kind = rng.randrange(len(text)), rng.random()
            text[at:at + (kind < 0.7)] = "" if 0.3 < kind < 0.7 else rng.choice("abcdefghz")
        around = ["".join(rng.choice("abcdefgh  ") for _ in range(60)) for _ in range(2)]
        texts.append(around[0] + "".join(text).upper() + around[1])

    def plain(text):
        return " ".join(text.lower().split())

    wanted = {}
    for k, text in enumerate(texts):
        for i, item in items:
            if plain(item) and (d := distance(plain(item), plain(text))) <= int(
                    len(plain(item)) * decontaminate.RATE):
                wanted[k, i] = d
    index = decontaminate.Items(items)
    found = {(k, index.ids[i]): d for k, i, d, *_ in index.find(texts)}
    assert found == wanted and len(wanted) > 20


def test_blocks_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(decontaminate.find_items(docs, benchmark).collect())
    monkeypatch.setattr(decontaminate, "BLOCK", 3000)
    assert sorted(decontaminate.find_items(docs, benchmark).collect()) == whole
    kept = {r.doc_id for r in decontaminate.keep_clean(docs, benchmark).collect()}
    assert kept.isdisjoint({r.doc_id for r in whole})


def test_table_of_shards():
    names = [f"s{i}" for i in range(7)]
    owner = sharding.lookup_table(names, 700)
    assert len(owner) == 701 and {owner.count(i) for i in range(7)} == {100, 101}
    fewer = sharding.lookup_table(names[:-1], 700)
    moved = sum(a != b for a, b in zip(owner, fewer) if a != 6)
    assert moved < 0.25 * len(owner)
    plain = queries.plain_owners(queries.SHARDS)
    assert [queries.SHARDS[i] for i in sharding.lookup_table(queries.SHARDS)] == plain


def test_written_shards(spark, tmp_path):
    rows = spark.range(2000).selectExpr("case when id < 900 then 1L else id end as doc_id", "id")
    sharding.write_shards(rows, f"{tmp_path}/out", ["a", "b"], files=3)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 2000
    assert back.select("doc_id", "shard").distinct().groupBy("doc_id").count().where(
        "count > 1").count() == 0


def test_sharding_query_writes_whole_documents(spark):
    found = queries.QUERIES["op9_sharding"](spark, SF)
    folders = {f.rsplit("/shard=", 1)[0] for f in found.inputFiles()}
    assert len(folders) == 1 and all("/shard=" in f for f in found.inputFiles())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    back = spark.read.parquet(folders.pop()).select(docs.columns)
    assert back.count() == docs.count() and back.exceptAll(docs).count() == 0


def test_katz_by_brute_force(spark, texts):
    found = {r.doc_id: r for r in katz.score(
        spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    rows = {i: ["<s>", *WORD.findall(t.translate(LOWER)), "</s>"] for i, t in texts.items()}
    one, two, first = (collections.Counter() for _ in range(3))
    for i, tokens in rows.items():
        if zlib.crc32(str(i).encode()) % 10:
            one.update(tokens[1:])
            two.update(zip(tokens, tokens[1:]))
            first.update(tokens[:-1])
    total = sum(one.values())
    d1, d2 = (katz.discounts(collections.Counter(c.values())) for c in (one, two))

    def less(count, d):
        return count - katz.HALF if count > katz.K else count * d[count - 1]

    unknown = 1 - sum(less(c, d1) for c in one.values()) / total
    after = collections.defaultdict(list)
    for (h, w), c in two.items():
        after[h].append((w, c))

    def single(w):
        return less(one[w], d1) / total if w in one else unknown

    alpha = {h: (1 - sum(less(c, d2) for _, c in known) / first[h])
             / (1 - sum(single(w) for w, _ in known)) for h, known in after.items()}
    for i, tokens in rows.items():
        base = sum(math.log10((one[w] + 0.1) / (total + 0.1 * (len(one) + 1))) for w in tokens[1:])
        score = sum(math.log10(less(two[h, w], d2) / first[h] if (h, w) in two
                               else alpha.get(h, 1) * single(w)) for h, w in zip(tokens, tokens[1:]))
        row = found[i]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (
            len(tokens) - 1, sum(w in one for w in tokens[1:]), total)
        assert row.base_score == pytest.approx(base) and row.score == pytest.approx(score)
    for h in ("<s>", next(iter(after))):
        seen = dict(after[h])
        rest = sum(single(w) for w in one if w not in seen) + unknown
        assert sum(less(c, d2) / first[h] for c in seen.values()) + alpha[h] * rest == (
            pytest.approx(1))


def test_katz_deals_out_what_is_common(spark, monkeypatch):
    rng = random.Random(5)
    texts = [(i, "of the " * rng.randint(1, 9) + " ".join(rng.choices("abcdefgh", k=9)) + f" {i % 90}")
             for i in range(400)] + [(None, "held out " * 30 + str(i)) for i in range(100)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")

    def scores():
        rows = katz.score(docs).collect()
        return sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6),
                       round(r.score, 6)) for r in rows)

    whole = scores()
    monkeypatch.setattr(katz, "HEAVY", 100)
    monkeypatch.setattr(katz, "BUCKET", 1000)
    assert scores() == whole
    # No partition gets much more than it is planned for, of texts that are held out as well.
    words = katz.learn_words(katz.count_words(docs, "doc_id", "text", 10))
    words.pairs = katz.heavy_pairs(docs, words, "doc_id", "text", 10)
    assert len(words.pairs[0]) >= 4
    buckets = -(-words.tokens // katz.BUCKET)
    sent = katz.bigrams(docs.repartition(1), words, buckets, "doc_id", "text", 10).collect()
    postings = [len(r.doc) // 4 for r in sent]
    assert buckets > 5 and len(postings) == buckets and max(postings) < 3 * sum(postings) / buckets


def test_katz_sends_a_bigram_once_per_slice(spark, monkeypatch):
    rng = random.Random(7)
    texts = [" ".join(rng.choices("abcde", k=rng.randint(0, 30)) + [f"w{i % 40}"] * (i % 3))
             for i in range(300)]
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)] * 2,
                                 "name string, text string")
    words = katz.learn_words(katz.count_words(docs, "name", "text", 10))
    sent = katz.bigrams(docs.repartition(1), words, 50, "name", "text", 10).collect()
    tokens = [["<s>", *t.split(), "</s>"] for t in texts]
    # However many documents hold them.
    assert sum(len(r.doc) // 4 for r in sent) == len({p for t in tokens for p in zip(t, t[1:])})

    def scores():
        return sorted((r.name, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6),
                       round(r.score, 6)) for r in katz.score(docs, "name", "text").collect())

    whole = scores()
    assert len(whole) == 600
    monkeypatch.setattr(katz, "TOKENS", 100)
    monkeypatch.setattr(katz, "BUCKET", 100)
    monkeypatch.setattr(katz, "HEAVY", 500)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, 20)
    try:
        names = [r.slice for r in katz.slices(docs, "name", "text", 10).collect()]
        assert len(set(names)) == len(names) > 20 and scores() == whole
    finally:
        spark.conf.set(size, before)


def test_articles_of_pages(spark):
    import html

    for page in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search("<article>(.*?)</article>", page.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1|h2|ul|li|div)[^>]*>", inner.replace("<br>", " "))
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
        assert html_text.extract(page.html) == "\n\n".join(b for b in blocks if b)


def test_page_without_an_article():
    page = """<header>Site</header><div class=menu><a href=x>a</a></div><h1>Title</h1>
      <p>Long paragraph of real text with many words in it.<p>Short.
      <p>Another long one, with <a href=y>a link</a> &amp; more text than links in it.</p>
      <div id=comments><p>A reader's comment of some length and some opinion.</div>
      <footer>end</footer>"""
    assert html_text.extract(page).split("\n\n") == [
        "Title", "Long paragraph of real text with many words in it.", "Short.",
        "Another long one, with a link & more text than links in it."]


def test_named_parts_of_a_page():
    page = """<body class="home"><div class="wrap has-sidebar"><nav><a href=x>Menu</a></nav>
      <div class="cookie-notice">We use cookies on this page, all of them.</div>
      <main><article><header class="entry-header"><h1>Title</h1></header>
      <p>First paragraph of the article, long enough to count.</p>
      <figure><img src=i><figcaption>A caption</figcaption></figure>
      <form><label>Your mail</label><input></form><div class="ad-box">Buy now, buy more</div>
      <p>Last one.</p></article></main>
      <section id="comments"><article class="comment"><p>A comment that is quite long and angry.
      </p></article></section></div><aside><p>Something else to read</p></aside></body>"""
    assert html_text.extract(page).split("\n\n") == [
        "Title", "First paragraph of the article, long enough to count.", "A caption", "Last one."]


@pytest.mark.parametrize("giant", [100, 3000, 20_000, 200_000])
def test_one_giant_paragraph(giant):
    texts = [f"{i} " + "some words " * 9 for i in range(61)]
    texts[30] = "long " * (giant // 5)
    texts = [t.strip() for t in texts]
    page = "<div class=menu><a href=x>a</a></div><div>%s</div><div><ul><li><a href=y>Other</a></ul>"
    page %= "<h1>Title</h1>" + "".join(f"<p>{t}</p>" for t in texts) + "<p>End</p>"
    assert html_text.extract(page).split("\n\n") == ["Title", *texts, "End"]


def test_several_articles():
    page = """<main></main><div><article><p>%s</p></article><article><p>Brief.</p></article></div>
      <section><article><a href=x>A card</a></article></section>""" % ("Many words. " * 2000)
    assert html_text.extract(page).split("\n\n") == [("Many words. " * 2000).strip(), "Brief."]


def test_paragraphs_in_divs():
    page = "<body><div class=c><div>Hi.</div>%s<div>Bye.</div></div></body>" % "".join(
        f"<div>{'word ' * 60}{i}</div>" for i in range(20))
    found = html_text.extract(page).split("\n\n")
    assert (found[0], found[-1], len(found)) == ("Hi.", "Bye.", 22)

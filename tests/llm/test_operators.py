"""Operators against plain versions on a small table with nulls, ties, repeats and long texts."""

import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lakeops.llm import bpe, chat, debruijn, decontaminate, jaccard, language, pages, pii, quality, suffix_dedup

PATH = public_tokenizers.path("word_bpe_49k.json")
WORD = r"[^\x20\x09-\x0D]+"
BASE = " ".join(f"word{i}" for i in range(120))
NEAR = BASE.replace("word60 ", "other ")
PASSAGE = " ".join(f"pass{i}" for i in range(60))
TEXTS = {
    1: BASE,
    2: BASE,
    3: NEAR,
    4: f"start of it {PASSAGE} and then an end",
    5: f"é another {PASSAGE} 😀 tail",
    6: "",
    7: None,
    8: " \n\t ",
    9: "one two",
    10: "same line here\nsame line here\n\nother # line\n" * 30,
    11: "a b " * 3000,
    12: "x" * 30000,
    13: "mail a.b@c.de or 4111 1111 1111 1111 at 10.0.0.255, +1 (017) 555-7713 <|endoftext|> don't",
    14: "Ten words of an item are here for the exam TODAY, ten words",
}
ITEMS = [(1, "ten words of an item are here for the exam today"), (2, "One, two"), (3, None), (None, "other line"), (4, "unseen words")]


def words(text, pattern=WORD):
    return re.findall(pattern, text or "")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", "y", i) for i, t in TEXTS.items()]
    # Further columns with names the operators use themselves.
    return spark.createDataFrame(rows, "doc_id long, text string, id string, words string, n int").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id < 0")


def by_id(df, key="doc_id"):
    return {row[key]: row for row in df.collect()}


@pytest.mark.parametrize("crowd", [1, 1000])
@pytest.mark.parametrize("keep_first", [True, False])
def test_suffix_dedup(docs, none, keep_first, crowd):
    got = by_id(suffix_dedup.remove_repeats(docs, length=40, gram=16, keep_first=keep_first, crowd=crowd))
    seen, raw = Counter(), {i: (t or "").encode() for i, t in TEXTS.items()}
    windows = [(i, s, b[s : s + 40]) for i, b in sorted(raw.items()) for s in range(len(b) - 39)]
    total = Counter(w for _, _, w in windows)
    gone = {i: bytearray(len(b)) for i, b in raw.items()}
    for i, s, w in windows:
        if seen[w] if keep_first else total[w] > 1:
            gone[i][s : s + 40] = b"\1" * 40
        seen[w] += 1
    for i, b in raw.items():
        assert got[i].kept == bytes(c for c, g in zip(b, gone[i]) if not g), i
        assert (got[i].n_removed, got[i].n_spans) == (sum(gone[i]), len(re.findall(b"\1+", gone[i])))
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_substring_dedup(docs, none):
    got = by_id(debruijn.remove_repeated_words(docs))
    seen = set()
    for i, t in sorted(TEXTS.items()):
        own, gone = words(t), set()
        for s in range(len(own) - 19):
            window = tuple(own[s : s + 20])
            gone |= set(range(s, s + 20)) if window in seen else set()
            seen.add(window)
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept) == (len(own), len(gone), kept)
    assert debruijn.remove_repeated_words(none).count() == 0


@pytest.mark.parametrize("block_bytes", [100, 1 << 20])
def test_decontamination(spark, docs, none, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = docs.unionAll(docs.where("doc_id = 14")).unionAll(docs.where("doc_id = 9").withColumn("doc_id", F.lit(None).cast("long")))
    found = decontaminate.contamination(rows, items, block_bytes=block_bytes).collect()
    assert len(found) == len(TEXTS) + 2
    got = {r.doc_id: r for r in found}
    assert (got[14].n_words, got[14].n_hit, got[14]["items"]) == (13, 11, ["1"])
    assert got[9].n_hit == 2 and got[9]["items"] == ["2"] and got[None].n_hit == 2
    assert got[10].n_hit == 0 or got[10]["items"] == []
    assert not got[7].contaminated and got[7].n_words == 0
    clean = decontaminate.drop_contaminated(rows, items, block_bytes=block_bytes)
    assert clean.columns == rows.columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in found if not r.contaminated}
    assert decontaminate.contamination(none, items).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(docs, items.where("item_id < 0")).collect())


def test_quality(docs, none):
    got = by_id(quality.judge(docs))
    for i, t in TEXTS.items():
        own = words(t)
        grams = Counter(zip(own, own[1:], own[2:]))
        hit = {k + j for k, g in enumerate(zip(own, own[1:], own[2:])) if grams[g] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        expected = (len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(own) < 50 or 2 * len(hit) > len(own))
    assert got[11].longest_repeat == 5998 and got[1].kept and not got[10].kept
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == {i for i, r in got.items() if r.kept}
    assert quality.judge(none).count() == 0


@pytest.mark.parametrize("k,percent,crowd", [(3, 90, 4096), (5, 80, 2), (1, 50, 3)])
def test_jaccard_join(docs, none, k, percent, crowd):
    got = by_id(jaccard.link_documents(docs, k=k, percent=percent, crowd=crowd))
    sets = {}
    for i, t in TEXTS.items():
        own = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(own[s : s + k]) for s in range(len(own) - k + 1)} or ({tuple(own)} if own else set())
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(sets[i]), root[i]) for i in sets}
    assert jaccard.link_documents(none).count() == 0


def test_tree_misses_no_pair():
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.poisson(5, (40, jaccard.GROUPS))
    points = np.concatenate([np.maximum(base + rng.integers(-1, 2, base.shape) * (rng.random(base.shape) < 0.1), 0) for _ in range(6)])
    sizes = points.sum(axis=1)
    tree = jaccard.Tree(points, sizes, np.arange(len(points)), leaf=8)
    met = {(min(i, j), max(i, j)) for a, b in tree.join(90) for i in a.tolist() for j in b.tolist() if i != j}
    for i in range(len(points)):
        for j in range(i):
            if np.minimum(points[i], points[j]).sum() * 190 >= 90 * (sizes[i] + sizes[j]):
                assert (j, i) in met


def test_bpe_round_trip(docs, none):
    library = Tokenizer.from_file(PATH)
    got = by_id(bpe.encode(docs, PATH))
    for i, t in TEXTS.items():
        expected = library.encode(t or "", add_special_tokens=False).ids
        assert got[i]["ids"] == expected, i
        assert got[i].decoded == library.decode(expected, skip_special_tokens=False)
    again = by_id(bpe.decode(bpe.encode(docs, PATH).select("doc_id", "ids"), PATH))
    assert all(again[i].decoded == got[i].decoded for i in TEXTS)
    assert bpe.encode(none, PATH).count() == 0


def test_personal_data(docs, none):
    got = by_id(pii.find_personal_data(docs))
    assert [(s.kind, s.value) for s in got[13].found] == [
        ("email", "a.b@c.de"), ("card", "4111 1111 1111 1111"), ("ip", "10.0.0.255"), ("phone", "+1 (017) 555-7713"),
    ]
    assert all(TEXTS[13][s.start : s.end] == s.value for s in got[13].found)
    assert not got[7].found and not got[12].found
    masked = by_id(pii.mask_personal_data(docs))
    assert masked[13].text.startswith("mail [EMAIL] or [CARD] at [IP], [PHONE] <|endoftext|>")
    assert masked[7].text is None and masked[1].text == BASE and masked[1].asDict().keys() == set(docs.columns)
    assert pii.find_personal_data(none).count() == 0


def test_checks_and_context(spark):
    texts = ["GB82 WEST 1234 5698 7654 32", "GB82 WEST 1234 5698 7654 33", "ssn 123-45-6789", "no 123-45-6789", "token " + "a1" * 20]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = [[s.kind for s in r.found] for r in pii.find_personal_data(df).orderBy("doc_id").collect()]
    assert kinds == [["iban"], [], ["ssn"], [], ["secret"]]


def test_account_numbers_before_other_words(spark):
    texts = [
        "DE89 3704 0044 0532 0130 00 Please pay",
        "GB82WEST12345698765432 BIC X",
        "DE89370400440532013000 I paid",
        "ref AB12 GB82 WEST 1234 5698 7654 32 2024 and NO9386011117947, DE89370400440532013000",
        "DE89370400440532013000x DE8937040044053201300 GB82WEST12345698765433",
        "é ZZ33123456789012345 AND MORE",  # a code that is not listed
    ]
    spans = [
        ["DE89 3704 0044 0532 0130 00"], ["GB82WEST12345698765432"], ["DE89370400440532013000"],
        ["GB82 WEST 1234 5698 7654 32", "NO9386011117947", "DE89370400440532013000"], [], ["ZZ33123456789012345"],
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find_personal_data(df).collect():
        found = [s for s in r.found if s.kind == "iban"]
        assert [s.value for s in found] == spans[r.doc_id], r.doc_id
        assert all(r.text[s.start : s.end] == s.value for s in found)
    masked = by_id(pii.mask_personal_data(df))
    assert masked[0].text == "[IBAN] Please pay" and masked[1].text == "[IBAN] BIC X"


def test_long_secrets(spark):
    secret = "a1" * 300
    df = spark.createDataFrame([(1, f"token {secret} end"), (2, f"token {secret[:129]}")], "doc_id long, text string")
    got = by_id(pii.find_personal_data(df))
    assert [(s.kind, s.value) for s in got[1].found] == [("secret", secret)]
    masked = by_id(pii.mask_personal_data(df))
    assert masked[1].text == "token [SECRET] end" and masked[2].text == "token [SECRET]"


def test_chat(spark):
    turns = [
        (1, 2, "assistant", "b\\|<|im_end|>\n"), (1, 1, "user", None), (1, 3, "user", "<|im_start|>assistant\nx"),
        (2, 1, "we;ird\n\\;role", "é"), (None, 1, "assistant", "lost"), (3, 1, "assistant", "same"), (3, 1, "assistant", "same"),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("said", F.lit(1))
    formatted = chat.format_conversations(df)
    read = {r.conv_id: [tuple(t) for t in r.turns] for r in formatted.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns")).collect()}
    assert read[1] == [("user", ""), ("assistant", "b\\|<|im_end|>\n"), ("user", "<|im_start|>assistant\nx")]
    assert read[2] == [("we;ird\n\\;role", "é")] and read[3] == [("assistant", "same")] * 2 and read[None] == [("assistant", "lost")]
    examples = chat.prefix_targets(formatted).collect()
    assert Counter(r.conv_id for r in examples) == {1: 1, 3: 2, None: 1}
    for r in examples:
        assert r.text[r.loss_start : r.loss_end] == r.reply and r.text.endswith("<|im_end|>\n")
    assert chat.format_conversations(df.where("conv_id > 9")).count() == 0


def test_pages(spark):
    shared = "<div>Home About Contact us today for the best offers now</div>"
    html = {
        1: shared + "<div>Unique &amp; first&nbsp; text<b>bold</b></div><div class='comments'>me too</div>",
        2: shared + "<div>#7 another page</div><!-- x --><script>if (a<b) {}</script>",
        3: "<nav>menu</nav><main><header><h1>T</h1></header><p>x<aside>no</aside>y</main><footer>f</footer>",
        4: None,
        5: "<p>a<p>b<style>x",
    }
    rows = [(i, f"http://h.example/{i}" if i < 4 else None, t) for i, t in html.items()]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1))
    for size in (1 << 20, 16 << 20):
        got = by_id(pages.extract_main_text(df, shard_bytes=size), "page_id")
        assert {i: r.text for i, r in got.items()} == {1: "Unique & first textbold", 2: "#7 another page", 3: "T x y", 4: "", 5: "a b"}
    assert pages.extract_main_text(df.where("page_id < 0")).count() == 0


MENU = "<ul><li>Home and about and contact</li><li>our offers for you today</li></ul>"
STORY = "<p>" + " ".join(f"story{i}" for i in range(30)) + "</p>"
QUOTE = "never was so much owed by so many to so few"
SITE = {
    1: MENU + STORY,
    2: MENU + STORY,  # an exact copy
    3: f"<h1>Print view</h1>{STORY}",
    4: f"{MENU}<p>He said {QUOTE} and left</p>",
    5: f"{MENU}<p>Again: {QUOTE} was said</p>",
    **{i: f"{MENU}<div>own{i} text{i}</div>" for i in range(6, 12)},
    12: f"<nav>{MENU}</nav><article>{STORY}</article>",
}
SITE_TEXTS = {
    **{i: STORY[3:-4] for i in (1, 2, 12)}, 3: f"Print view {STORY[3:-4]}", 4: f"He said {QUOTE} and left",
    5: f"Again: {QUOTE} was said", **{i: f"own{i} text{i}" for i in range(6, 12)},
}


def site(spark, pages_of=SITE):
    rows = [(i, f"http://h.example/{i}", t) for i, t in pages_of.items()]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_page_copies(spark):
    assert {i: r.text for i, r in by_id(pages.extract_main_text(site(spark)), "page_id").items()} == SITE_TEXTS
    few = {i: t for i, t in SITE.items() if i in (1, 2, 3)}
    got = by_id(pages.extract_main_text(site(spark, few)), "page_id")
    assert all(STORY[3:-4] in got[i].text for i in few)


@pytest.mark.parametrize("shard_bytes", [100, 700])
def test_pages_of_split_hosts(spark, shard_bytes):
    """Texts do not depend on how many shards a host is dealt into."""
    got = by_id(pages.extract_main_text(site(spark), shard_bytes=shard_bytes), "page_id")
    assert {i: r.text for i, r in got.items()} == SITE_TEXTS


def test_suffix_array_and_common_prefixes():
    draw = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 40, 150):
        for letters in (1, 2, 5):
            symbols = np.append(draw.integers(0, letters, n), 9)
            order, common = pages.suffix_array(symbols)
            tails = sorted(range(n + 1), key=lambda i: symbols[i:].tolist())
            assert order.tolist() == tails
            for i in range(1, n + 1):
                a, b = symbols[tails[i - 1] :].tolist(), symbols[tails[i] :].tolist()
                assert common[i] == next(k for k in range(n + 1) if a[k] != b[k])


def test_shared_places_against_all_substrings():
    draw = np.random.default_rng(6)
    for case in range(40):
        texts = [draw.integers(0, 2 + case % 3, draw.integers(0, 25)).tolist() for _ in range(6)]
        content = np.array([0, 1, 1, 2, 3, 4])
        length, needed = 3 + case % 4, 2 + case % 2
        expected = []
        for own in texts:
            marks = [False] * len(own)
            for i in range(len(own)):
                for j in range(i + length, len(own) + 1):
                    holders = {c for c, t in zip(content, texts) if any(t[k : k + j - i] == own[i:j] for k in range(len(t)))}
                    if len(holders) >= needed:
                        marks[i:j] = [True] * (j - i)
            expected += marks
        page = np.repeat(np.arange(6), [len(t) for t in texts])
        symbols = np.array([x for t in texts for x in t], np.int64)
        assert pages.shared_places(symbols, page, length, content, needed).tolist() == expected


def test_menus_of_a_host_do_not_outweigh_marked_parts(spark):
    """Only what the suffix array leaves of open text is weighed against articles that may be teasers."""
    menu = "<div>" + " ".join(f"menu{i}" for i in range(40)) + "</div>"
    own = "<div>" + " ".join(f"body{i}" for i in range(30)) + "</div>"
    html = {i: f"{menu}<article>part{i} one</article><article>part{i} two</article>" for i in range(6)}
    html[6] = f"{menu}{own}<article>card6 one</article><article>card6 two</article>"
    html[7] = f"{menu}<article class=card>all of {7}</article>"
    for size in (100, 16 << 20):
        got = by_id(pages.extract_main_text(site(spark, html), shard_bytes=size), "page_id")
        assert {i: got[i].text for i in range(6)} == {i: f"part{i} one part{i} two" for i in range(6)}
        assert got[6].text == own[5:-6] and got[7].text == "all of 7"


@pytest.mark.parametrize("shard_bytes", [150, 1 << 20])
def test_every_page_goes_through_the_array_of_its_host(spark, monkeypatch, shard_bytes):
    """Hosts whose pages all mark one article, and hosts of one page, are compared like the others."""

    def counting(min_tokens):
        """Before each text the number of tokens outside the main part that its array took; workers have their own module."""

        def run(batches):
            import pyarrow as pa

            from lakeops.llm import pages as here

            plain, seen = here.shared_places, []
            here.shared_places = lambda symbols, *rest: seen.append(len(symbols)) or plain(symbols, *rest)
            try:
                for batch in here._settle(min_tokens)(batches):
                    texts = [f"{seen[-1]}|{t}" for t in batch.column("text").to_pylist()]
                    yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts)], ["page_id", "url", "text"])
            finally:
                here.shared_places = plain

        return run

    monkeypatch.setattr(pages, "_settle", counting)
    menu = "<nav><a>one</a><a>two</a></nav>"
    rows = [(i, f"http://many.example/{i}", f"{menu}<article>text of {i}</article><p>more {i}</p>") for i in range(6)]
    rows += [(6, "http://one.example/a", f"{menu}<article>alone</article>"), (7, "http://two.example/a", f"<p>open {menu}</p>"), (8, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text.split("|") for r in pages.extract_main_text(df, shard_bytes=shard_bytes).collect()}
    assert [t for _, (_, t) in sorted(got.items())] == [f"text of {i}" for i in range(6)] + ["alone", "open", ""]
    assert all(int(n) > 0 for i, (n, _) in got.items() if i < 8) and int(got[8][0]) == 0
    if shard_bytes > 150:
        assert {int(got[i][0]) for i in range(6)} == {6 * 12}  # tags and words of all six pages


def test_page_attributes(spark):
    inner = (
        "<p>a <a href='/hidden-gems'>gem</a> <span title=\"the hidden cost\" data-id='search'>cost</span></p>"
        "<div class='section-header'>Part</div><div class='related-work alert' id=notice>known</div>"
        "<div class='comments'>me too</div><div class=newsletter>join</div><p hidden>no</p><div role='search'>find</div>"
    )
    html = {1: f"<article>{inner}</article>", 2: f"<main class='has-sidebar'>{inner}</main>", 3: "<p>x <b alt='a hidden gem'>y</b><i class='sidebar'>z</i>"}
    df = spark.createDataFrame([(i, f"http://a{i}.example", t) for i, t in html.items()], "page_id long, url string, html string")
    got = by_id(pages.extract_main_text(df), "page_id")
    assert {i: r.text for i, r in got.items()} == {1: "a gem cost Part known", 2: "a gem cost Part known", 3: "x y"}


def test_language_mixture(spark, none):
    sample = [("the cat and the dog of the house " * 5, "en"), ("le chat et le chien de la maison " * 5, "fr")] * 5
    learned = spark.createDataFrame(sample + [(None, "en"), ("x", None)], "text string, lang string")
    texts = ["the house of the dog", "le chien de la maison", "12 34", None, "", "the cat and the house of the dog le chat et le chien de la maison " * 8]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(language.identify(df, learned))
    assert [got[i].lang_pred for i in range(5)] == ["en", "fr", "und", "und", "und"]
    assert set(got[5].proportions) == {"en", "fr"} and 0.3 < got[5].score < 0.7
    assert by_id(language.identify(df, learned.where("lang = 'xx'")))[0].lang_pred == "und"
    assert language.identify(none, learned).count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(0).cast("long").alias("n_chars"))
    rows = rows.unionAll(rows.where("doc_id = 1")).unionAll(rows.where("doc_id = 4").withColumn("doc_id", F.lit(None).cast("long")))
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["near_duplicates"](spark, rows, str(tmp_path))
    ids = Counter(r.doc_id for r in kept.collect())
    assert kept.columns == rows.columns and ids[1] == 1 and not ids[2] and not ids[3]
    assert ids[4] + ids[None] == 1 and ids[6] == ids[7] == ids[8] == 1
    assert {r.doc_id for r in stages["decontamination"](spark, rows, str(tmp_path)).collect()} >= {1, 2, 3, 4, 5, 6, 7, 8, None}
    masked = by_id(stages["personal_data"](spark, rows, str(tmp_path)))
    assert masked[13].n_chars == len(masked[13].text) and "[EMAIL]" in masked[13].text
    assert stages["tokens"](spark, rows, str(tmp_path)).count() == rows.count()
    assert {r.doc_id for r in stages["quality"](spark, rows, str(tmp_path)).collect()} >= {1, 2, 3, 4, 5}

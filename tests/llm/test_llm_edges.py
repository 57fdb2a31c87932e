"""Defined results on nulls, empty and very long texts, ties, repeated rows, empty tables and
extra columns whose names clash with those the operators add."""

import hashlib
import zlib
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from rivulet.llm.common import stored
from rivulet.llm.exact import drop_exact_duplicates, exact_groups
from rivulet.llm.html import extract_text, main_text
from rivulet.llm.huffman import read_ids, write_ids
from rivulet.llm.lines import apply_bitmaps, line_keep_bitmaps
from rivulet.llm.mixing import mix_sources
from rivulet.llm.packing import pack_documents, sequences
from rivulet.llm.quality import kept_documents, quality_rules
from rivulet.llm.queries import tokenizer_path
from rivulet.llm.secrets import find_secrets
from rivulet.llm.simhash import simhash_groups
from rivulet.llm.substrings import kept_bytes, repeated_spans
from rivulet.llm.units import tokenizer_settings

LONG = "the quick brown fox jumps over the lazy dog and runs away. " * 4000
TEXTS = [
    (1, None, "a"), (None, "lost id words here", "a"), (2, "", None), (3, " \t\n\x0b\x0c\r ", None), (4, "one", "b"),
    (4, "one", "b"), (4, "two words\nsecond line", "b"), (None, None, None), (5, LONG, "c"), (6, LONG, "c"),
    (7, "É É ß\n日本 x 😀\n\nend\n", "é"), (8, "token = abcdef0123456789abcdef0123456789", "a"), (9, "one", None),
]
SCHEMA = "doc_id bigint, text string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(TEXTS, SCHEMA)
    clash = ["size", "kept", "n_words", "n_lines", "spans", "copies", "taken", "target", "base_failed", "id", "file", "row", "ids", "n", "c"]
    return df.select("*", *[F.lit("x").alias(c) for c in clash], F.lit(None).cast("string").alias("lang"))


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id = -1")


def test_quality(docs, none):
    rows = quality_rules(docs).collect()
    assert len(rows) == len(TEXTS) and all(r["base_failed"] and not r["kept"] for r in rows if (r["text"] or "").count(" ") < 9)
    long = [r for r in rows if r["doc_id"] == 5][0]
    assert long["n_repeat_words"] == long["n_words"] == 48000 and not long["kept"]
    assert quality_rules(none).count() == 0
    assert kept_documents(docs).columns == docs.columns and kept_documents(docs).count() == 0


def test_quality_counts_match_brute_force(spark):
    texts = ["a b c d e f a b c d e", "a a a a a a a", "x\nx\n\n \nx", "#*$%&|<> word", "a b c d e a b c d e a b c d e q r s t u v w",
             "1 2 3 4 5 6 7 8 9 10", "p q r s t p q r s t u p q r s t"]
    got = quality_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).orderBy("doc_id").collect()
    for r, t in zip(got, texts):
        w = t.split()
        seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        covered = {i + k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(5)}
        lines = [x for x in t.split("\n") if x.split()]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_stop_words_of_listed_languages_only(spark):
    import random
    rng = random.Random(6)
    text = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(7)) for _ in range(80))
    latin, digits = text("bcdfghklm"), " ".join(str(10 ** 6 + i) for i in range(80))
    rows = [(text("абвгдежзи"), None, True), (text("αβγδεζηθι"), "el", True), (text("ابتثجحخد"), "", True), (text("абвгдежзи"), "en", True),
            (latin, None, False), (latin, "en-GB", False), (latin, "DE", False), (latin, "", False), (latin, "pl", True),
            (digits, None, False), (latin + " the of and in", "en", True)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id int, text string, lang string, want boolean")
    got = quality_rules(df).collect()
    assert [r["kept"] for r in sorted(got, key=lambda r: r["doc_id"])] == [r[2] for r in rows]
    assert {r["doc_id"] for r in quality_rules(df.drop("lang")).where("kept").collect()} == {0, 1, 2, 3, 10}


def test_exact(docs, none):
    rows = exact_groups(docs).collect()
    groups = Counter(brute.normal_sha(t) for _, t, _ in TEXTS)
    assert len(rows) == len(TEXTS) and sum(r["kept"] for r in rows) == len(groups)
    for r in rows:
        assert r["group_size"] == groups[r["digest"].hex()]
    ones = [r for r in rows if r["digest"].hex() == brute.normal_sha("one")]
    assert {r["keep_id"] for r in ones} == {4} and sorted(r["kept"] for r in ones) == [False, False, True]
    empty = [r for r in rows if r["digest"].hex() == brute.normal_sha("")]
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in empty} == {(1, 1, True), (2, 1, False), (None, 1, False)}
    assert exact_groups(none).count() == 0


def test_exact_checks_bytes_behind_a_weak_digest(spark):
    texts = [(i, t) for i, t in enumerate(["aa", "bb", "aa", "cc", "bb", "d", "aa  x", "aa x"])]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    rows = exact_groups(df, digest=lambda t: F.encode(F.length(t).cast("string"), "UTF-8"), files_per_trigger=1).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in rows} == {
        (0, 0, 2, True), (2, 0, 2, False), (1, 1, 2, True), (4, 1, 2, False), (3, 3, 1, True), (5, 5, 1, True), (6, 6, 2, True), (7, 6, 2, False)}


def test_exact_drop(docs, none):
    kept = drop_exact_duplicates(stored(docs, "edge"))
    assert kept.columns == docs.columns and kept.count() == len({brute.normal_sha(t) for _, t, _ in TEXTS})
    assert drop_exact_duplicates(stored(none, "edge")).count() == 0


def test_lines(docs, none):
    out = apply_bitmaps(docs, line_keep_bitmaps(docs, min_docs=2, keep_first=False))
    assert out.count() == len(TEXTS)
    got = {(r["doc_id"], r["text"]): r for r in out.collect()}
    assert (got[1, None]["n_lines"], got[1, None]["n_dropped"], got[1, None]["kept_text"]) == (1, 0, "")
    assert got[4, "one"]["kept_text"] == got[9, "one"]["kept_text"] == "" and got[4, "one"]["n_dropped"] == 1
    assert got[7, TEXTS[10][1]]["kept_text"] == TEXTS[10][1]
    assert line_keep_bitmaps(none).count() == 0 and apply_bitmaps(none, line_keep_bitmaps(none)).count() == 0


def test_lines_keep_first(spark):
    rows = [(3, "A \nb\nc"), (1, "x\na\na"), (None, "a\nB"), (2, "c\nd")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = apply_bitmaps(df, line_keep_bitmaps(df, min_docs=2, keep_first=True))
    assert {r["doc_id"]: r["kept_text"] for r in out.collect()} == {1: "x\na", 2: "c\nd", 3: "b", None: ""}


def test_mixing(docs, none):
    rows = mix_sources(docs).collect()
    assert len(rows) == len(TEXTS) and all(r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 3 for r in rows)
    assert mix_sources(none).count() == 0


def test_mixing_meets_targets_when_ids_are_missing_or_repeated(spark):
    import random
    rng = random.Random(6)
    rows = [(None if i % 3 == 0 else i % 7 if i % 3 == 1 else i, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randint(1, 40))), rng.choice("abc")) for i in range(900)]
    got = mix_sources(spark.createDataFrame(rows, SCHEMA)).collect()
    largest = max(r["size"] for r in got)
    for source in "abc":
        own = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= largest


def test_mixing_caps_and_reshares(spark):
    rows = [(i, "w " * 10, "big") for i in range(300)] + [(1000 + i, "w " * 5, "small") for i in range(4)]
    got = mix_sources(spark.createDataFrame(rows, SCHEMA), weights=(1, 2)).collect()
    target = {r["source"]: r["target"] for r in got}
    assert target == {"small": 60.0, "big": 2960.0}  # 3 x 20 words; the rest is reshared
    assert sum(r["taken"] for r in got if r["source"] == "small") == 60
    assert abs(sum(r["taken"] for r in got if r["source"] == "big") - 2960) <= 10


def test_secrets(docs, none):
    rows = {(r["doc_id"], r["text"]): r["spans"] for r in find_secrets(docs).collect()}
    text = TEXTS[11][1]
    assert [(s["kind"], s["start"], s["end"]) for s in rows[8, text]] == [("assign", 0, len(text)), ("hex", 8, len(text)), ("guess", 8, len(text))]
    assert rows[1, None] == [] and rows[2, ""] == [] and find_secrets(none).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_and_packing(spark, docs, none, name):
    settings, want = tokenizer_settings(tokenizer_path(name)), brute.token_ids(name, [t for _, t, _ in TEXTS])
    place = spark.conf.get("spark.checkpoint.dir", None) or "/tmp/rivulet-edge"
    import tempfile
    folder = tempfile.mkdtemp(dir=None if place.startswith("file:") else place if __import__("os").path.isdir(place) else None) + "/ids"
    write_ids(docs, folder, settings)
    rows = sorted(read_ids(spark, folder).collect(), key=lambda r: r["start"])
    assert Counter((r["id"], bytes(r["ids"])) for r in rows) == Counter((i, x) for (i, _, _), x in zip(TEXTS, want))
    assert [r["id"] for r in rows] == sorted((i for i, _, _ in TEXTS), key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:k]) for k in range(len(rows))]
    write_ids(none, folder + "-none", settings)
    assert read_ids(spark, folder + "-none").count() == 0
    packed = pack_documents(docs, settings, size=1024, with_ids=True)
    expected: dict = {}
    for (i, _, _), x in zip(TEXTS, want):
        expected.setdefault(i, []).append(x)
    brute.check_packing([r.asDict() | {"ids_crc32": r["crc"]} for r in packed.collect()], expected, 1024)
    assert sum(len(r["ids"]) for r in sequences(packed).collect()) == sum(map(len, want))
    assert pack_documents(none, settings).count() == 0


def test_substrings(docs, none):
    rows = repeated_spans(docs, length=400).collect()
    raws = [(t or "").encode() for _, t, _ in TEXTS]
    # over 400 bytes there is only the long text, twice and periodic
    assert Counter((r["doc_id"], tuple(map(tuple, r["spans"]))) for r in rows) == Counter(
        (i, ((0, len(raw)),) if len(raw) >= 400 else ()) for (i, _, _), raw in zip(TEXTS, raws))
    assert repeated_spans(none).count() == 0


@pytest.mark.parametrize("max_bucket", [1, 4096])
def test_substrings_against_brute_force(spark, max_bucket):
    import random
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(n)) for n in (8, 14, 20, 60)]
    texts = [None, "", "é" * 90, "ab" * 120, "ab" * 60]
    for _ in range(60):
        p = rng.choice(passages)
        edited = p[:rng.randrange(len(p))] + rng.choice(["", "#", "é"]) + p[rng.randrange(len(p)):]
        texts.append(" ".join([word() for _ in range(rng.randint(0, 12))] + [rng.choice([p, edited])] + [word() for _ in range(rng.randint(0, 12))]))
    raws = [(t or "").encode() for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    got = repeated_spans(df, length=40, window=28, max_bucket=max_bucket).withColumn("kept", kept_bytes(F.col("text"), F.col("spans"))).collect()
    want = brute.repeated_bytes(raws, 40)
    assert any(want) and len(got) == len(texts)
    for r in got:
        assert [tuple(s) for s in r["spans"]] == want[r["doc_id"]]
        assert bytes(r["kept"]) == brute.cut(raws[r["doc_id"]], want[r["doc_id"]])


def test_substrings_are_cut_without_python_workers(spark):
    """The step that reads every text again runs beside no worker: each of them takes memory of its executor."""
    line = "".join(chr(97 + i * i % 23) for i in range(500))
    texts = ["é" + line, line + "ü" * 3, "", None, line * 2 + "-" * 300 + line]
    found = repeated_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))
    kept = found.select("doc_id", "spans", kept_bytes(F.col("text"), F.col("spans")).alias("kept"))
    assert "Python" not in kept._jdf.queryExecution().executedPlan().toString()
    raws = [(t or "").encode() for t in texts]
    want = brute.repeated_bytes(raws, 400)
    assert len(want[4]) > 1
    assert {r["doc_id"]: bytes(r["kept"]) for r in kept.collect()} == {i: brute.cut(raw, runs) for i, (raw, runs) in enumerate(zip(raws, want))}


@pytest.mark.parametrize("max_bucket", [1, 4096])
def test_substrings_with_a_gram_twice_in_a_window(spark, max_bucket):
    """Two anchors with the same q-gram cover one string: it must not count as two."""
    import random
    rng = random.Random(11)
    texts = []
    word = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    for _ in range(12):
        line = word(rng.randint(16, 22)) + "\n"
        passage = word(rng.randint(4, 30)) + line * rng.randint(2, 3) + word(rng.randint(4, 30))
        texts += [word(40) + passage[:len(passage) - rng.randrange(12)] + word(40) for _ in range(4)]
        texts.append(word(30) + "-" * rng.randint(24, 44) + word(30))
    raws = [t.encode() for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    got = repeated_spans(df, length=40, window=28, max_bucket=max_bucket).collect()
    want = brute.repeated_bytes(raws, 40)
    assert any(want) and {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in got} == dict(enumerate(want))


def test_simhash(docs, none):
    rows = simhash_groups(docs).collect()
    assert len(rows) == len(TEXTS)
    blank = {(r["doc_id"], r["fp"], r["component_id"]) for r in rows if r["fp"] == 0}
    assert blank == {(1, 0, 1), (2, 0, 1), (3, 0, 1), (None, 0, 1)}
    assert simhash_groups(none).count() == 0


def test_near_duplicates_go_row_by_row(spark):
    """Null and repeated ids: of each group of near copies one row stays, and every other text."""
    import random

    import corpus_pipeline as cp
    rng = random.Random(4)
    a, b, c, d, e = (" ".join("".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(400)) for _ in range(5))
    near = str.title  # the same fingerprint, another text
    rows = [(5, a), (5, b), (3, near(b)), (9, near(a)), (None, c), (None, near(c)), (7, d), (None, near(d)), (None, e)]
    group = {t: k for k, text in enumerate((a, b, c, d, e)) for t in (text, near(text))}
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for docs in (stored(df.repartition(3), "near"), df):
        got = cp.keep_near(spark, docs, "")
        assert got.columns == df.columns
        assert sorted((r["doc_id"] or 0, group[r["text"]]) for r in got.collect()) == [(0, 2), (0, 4), (3, 1), (5, 0), (7, 3)]
    assert cp.keep_near(spark, df.where("doc_id = 0"), "").count() == 0


def test_html(spark):
    pages = [
        (1, None, ""), (2, "", ""), (3, "plain words only, without any markup at all", "plain words only, without any markup at all"),
        (4, "<body><header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav><main><article>"
            "<header><h1>Title &amp; more</h1></header><p>First  para &lt;1&gt;\n with <b>bold</b> and <a href=z>a link</a> text.<p>Second&nbsp;para that is"
            " rather longer than the first one was.<script>var x='</p>';</script><ul><li>an item of the list</ul></article>"
            "<aside class=sidebar><p>Related things that nobody wants to read in here.</p></aside><section id=comments><p>I liked this"
            " article a lot, thank you for it!</p></section></main><div class='cookie-notice'><p>We use cookies to improve things.</p></div>"
            "<form><label>Mail</label><input name=q><button>Go</button></form><footer>&copy; 2020</footer>",
         "Title & more\nFirst para <1> with bold and a link text.\nSecond para that is rather longer than the first one was.\nan item of the list"),
        (4, "<p>cut off in an ent &am", "cut off in an ent &am"),
    ]
    df = spark.createDataFrame([(i, h, "x") for i, h, _ in pages], "page_id int, html string, text string")
    assert sorted((r["page_id"], r["text"]) for r in extract_text(df).collect()) == sorted((i, t) for i, _, t in pages)
    assert extract_text(df.where("page_id = 0")).count() == 0


def test_html_head_left_open_and_formulas():
    para = "A paragraph that is long enough to be taken as the text of this page."
    for page in (f"<html><head><title>T</title><body><article><p>{para}</article>", f"<head><meta charset=utf-8><title>T</title><p>{para}",
                 f"<head><style>p {{}}</style><script>x='<p>'</script><noscript><img src=x></noscript><article><p>{para}</article>",
                 f"<head><title>T</title></head><body><p>{para}", f"<head><title>T</title>{para}"):
        assert main_text(page) == para
    page = f"<article><p>{para} <math><mi>E</mi><mo>=</mo><mi>m</mi><annotation>E=m</annotation></math> holds.</p></article>"
    assert main_text(page) == f"{para} E=m holds."


def test_html_names_within_an_article():
    first, second = "The first paragraph of this article is long enough to be kept.", "The second paragraph says something else at some length, too."
    page = "<body><article{}><p>" + first + "</p>{}</article></body>"
    for kept in (f'<section id="discussion"><p>{second}</p></section>', f'<div id="search-algorithms"><p>{second}</p></div>',
                 f'<p class="notice">{second}</p>', f'<div class="tag-newsletter"><p>{second}</p></div>'):
        assert main_text(page.format("", kept)) == f"{first}\n{second}"
    assert main_text(page.format("", f'<h2 id="related-work">Related work</h2><p>{second}</p>')) == f"{first}\nRelated work\n{second}"
    assert main_text(page.format(' class="post category-social"', f"<p>{second}</p>")) == f"{first}\n{second}"
    for gone in ('<section id="comments">', '<div class="share">', '<div class="related-posts">', '<div class="cookie-banner">',
                 '<div id="search-form">', '<div class="sidebar-left">'):
        assert main_text(page.format("", f"{gone}<p>{second}</p></{gone[1:4] if gone[1] == 'd' else 'section'}>")) == first


def test_crc_is_unsigned(spark):
    assert spark.range(1).select(F.crc32(F.lit(b"abc")).alias("c")).first()["c"] == zlib.crc32(b"abc")
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit(""), 256).alias("c")).first()["c"]

"""Each registered query against its oracle SQL or a brute-force version on the smallest tables."""

import hashlib
import os
import re
import zlib
from html import unescape

import brute
import pytest
from conftest import SF_SMALL
from oracle_compare import compare, duck

from rivulet.llm import queries as q
from rivulet.llm.secrets import ACCESS, ASSIGN, HEX, guess_cost
from rivulet.plans import Query

SQL = q.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, name):
    res = compare(spark, Query(name, q.queries()[name], SQL[name], ""), SF_SMALL, duck(SF_SMALL))
    assert res["ok"], res


def test_quality_sql_knows_the_languages_too(spark):
    import duckdb
    from rivulet.llm.quality import quality_rules
    texts = [("слово " + "другое иное третье пятое шестое " * 14, lang) for lang in (None, "en", "ru")]
    texts += [(" ".join(f"kolme{i} sana{i}" for i in range(40)), lang) for lang in (None, "en", "fi", "FI-fi", "de_AT", " unknown ")]
    rows = [(i, t, lang) for i, (t, lang) in enumerate(texts)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    result = con.sql(SQL["op5_quality_rules"])
    want = {r[result.columns.index("doc_id")]: r[result.columns.index("kept")] for r in result.fetchall()}
    assert got == want and len(set(want.values())) == 2


def test_every_query_is_an_operator_number():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in q.queries()) == list(range(1, 14))


def test_secret_scan(spark):
    got = {r["doc_id"]: r for r in q.queries()["op2_secret_scan"](spark, SF_SMALL).collect()}
    rows = brute.table(SF_SMALL, "documents", "doc_id", "text")
    assert len(got) == len(rows)
    for doc, text in rows:
        assign = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        access = [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
        hexa = [("hex", *m.span()) for m in HEX.finditer(text) if len(m[0]) >= 24]
        order = {"assign": 0, "access": 1, "hex": 2, "guess": 3}
        base = sorted(assign + access + hexa, key=lambda s: (s[1], order[s[0]]))
        r = got[doc]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (len(assign), len(access), len(hexa))
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        assert ",".join(":".join(s) for s in spans if s[0] != "guess") == listed
        assert spans == sorted(spans, key=lambda s: (int(s[1]), order[s[0]]))
        for _, s, e in (s for s in spans if s[0] == "guess"):
            assert guess_cost(text[int(s):int(e)])[0] >= 10


def test_html(spark):
    got = {r["page_id"]: r for r in q.queries()["op3_html_min_cut"](spark, SF_SMALL).collect()}
    rows = brute.table(SF_SMALL, "pages", "page_id", "url", "html")
    assert len(got) == len(rows)
    for page, url, html in rows:
        article = html[html.find("<article>") + 9:]
        article = article[:article.find("</article>")]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(p for p in parts if p)
        assert (got[page]["text"], got[page]["url"], got[page]["n_chars"]) == (want, url, len(want))


def test_token_ids(spark):
    rows = sorted(brute.table(SF_SMALL, "documents", "doc_id", "text"))
    at, want = 0, set()
    for (doc, _), ids in zip(rows, brute.token_ids("word_bpe_49k.json", [t for _, t in rows])):
        want.add((doc, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    got = q.queries()["op4_huffman_ids"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert {tuple(r) for r in got.collect()} == want


def test_substrings(spark):
    rows = brute.table(SF_SMALL, "documents", "doc_id", "text")
    raws = [t.encode() for _, t in rows]
    want = {(doc, len(raw), sum(e - s for s, e in runs), len(runs), hashlib.sha256(brute.cut(raw, runs)).hexdigest())
            for (doc, _), raw, runs in zip(rows, raws, brute.repeated_bytes(raws, 400))}
    assert any(0 < w[2] < w[1] for w in want)
    assert {tuple(r) for r in q.queries()["op8_suffix_dedup"](spark, SF_SMALL).collect()} == want


def test_simhash(spark):
    want = brute.simhash(brute.table(SF_SMALL, "documents", "doc_id", "text"))
    assert {tuple(r) for r in q.queries()["op9_simhash_near_dedup"](spark, SF_SMALL).collect()} == want


def test_packing(spark):
    rows = brute.table(SF_SMALL, "documents", "doc_id", "text")
    ids = brute.token_ids("byte_bpe_50k.json", [t for _, t in rows])
    got = q.queries()["op10_best_fit_packing"](spark, SF_SMALL).collect()
    used = brute.check_packing(got, {doc: [x] for (doc, _), x in zip(rows, ids)}, 1024)
    least = -(-sum(len(x) // 4 for x in ids) // 1024)
    assert used <= least * 1.05 + 2


def test_mixing_meets_targets(spark):
    rows = q.queries()["op7_mix_sources"](spark, SF_SMALL).collect()
    sources = dict(brute.table(SF_SMALL, "documents", "doc_id", "source"))
    total, taken, targets, largest = sum(r["size"] for r in rows), {}, {}, {}
    for r in rows:
        s = sources[r["doc_id"]]
        taken[s] = taken.get(s, 0) + r["taken"]
        targets[s] = r["target"]
        largest[s] = max(largest.get(s, 0), r["size"])
        assert r["taken"] <= 3 * r["size"]
    assert abs(sum(targets.values()) - total) < 1e-6 * total
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in targets)
    again = q.queries()["op7_mix_sources"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_pipeline(spark):
    """The whole pipeline against brute force: which documents reach the packing, and how often."""
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {r["doc_id"] for r in q.queries()["op5_quality_rules"](spark, SF_SMALL).where("kept").collect()}
    stage = cp.keep_quality(spark, docs, SF_SMALL)
    assert stage.schema == docs.schema and {r["doc_id"] for r in stage.collect()} == kept

    def stored(df, name):
        from rivulet.llm.common import stored
        return stored(df, name)

    first = {}
    for i in sorted(kept):
        first.setdefault(brute.normal_sha(rows[i]), i)
    stage = stored(cp.keep_exact(spark, stored(stage, "s1"), SF_SMALL), "s2")
    assert stage.columns == docs.columns and sorted(r["doc_id"] for r in stage.collect()) == sorted(first.values())
    near = brute.simhash([(i, rows[i]) for i in first.values()])
    stage = stored(cp.keep_near(spark, stage, SF_SMALL), "s3")
    assert stage.columns == docs.columns
    assert sorted(r["doc_id"] for r in stage.collect()) == sorted(i for i, _, c in near if i == c)
    from rivulet.llm.mixing import mix_sources
    copies = {r["doc_id"]: r["copies"] for r in mix_sources(stage).collect()}
    mixed = stored(cp.mix(spark, stage, SF_SMALL), "s4")
    assert mixed.columns == docs.columns
    assert sorted(r["doc_id"] for r in mixed.collect()) == sorted(i for i, n in copies.items() for _ in range(n))
    ids = {i: [x] * copies[i] for i, x in zip(copies, brute.token_ids("byte_bpe_50k.json", [rows[i] for i in copies])) if copies[i]}
    got = cp.run(spark, SF_SMALL)
    brute.check_packing(got.collect(), ids, 1024)


def test_entry_registers_everything():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert "pipeline" in names and set(q.queries()) <= names and set(entry.oracle_sql()) <= names
    assert os.path.exists(os.path.join(os.path.dirname(entry.__file__), "corpus_pipeline.py"))

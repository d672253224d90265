"""The operators on small fixtures with nulls, ties, repeated rows and clashing names."""

import hashlib
import random
import re
from itertools import product

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadenza.llm import bpe, decontaminate, html_text, jaccard_groups, pii, quality, url_filters, warc
from cadenza.llm.components import components
from cadenza.llm.quality_sql import QUALITY_SQL
from cadenza.llm.tagger import Tagger

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- URL filters --------------------------------------------------------------------


def test_rules_of_any_length_at_once():
    rules = [url_filters.Rule(f"v{i}", h, p) for i, (h, p) in enumerate([("org", "/"), ("*.net", "/a*b/c"), ("x?.com", "/"), ("a" * 90 + ".com", "/" + "q" * 80), ("b.org", "/x")])]
    automaton = url_filters.Automaton(rules)

    def naive(host, path):
        best = None
        for r in rules:
            part = lambda t: "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in t)
            if re.fullmatch(rf"(?:.*\.)?{part(r.host)}", host) and re.match(part(r.path), path) and (best is None or len(r.text) > len(best)):
                best = r.text
        return best

    hosts = ["org", "x.org", "xorg", "b.org", "a.b.org", "k.net", "net", "xy.com", "z.xy.com", "a" * 90 + ".com", ""]
    paths = ["/", "", "/x", "/ab/c", "/azzb/cc", "/a/b", "/" + "q" * 80, "/x.org/"]
    cases = list(product(hosts, paths))
    whole = pa.array([f".{h}\0{p}" for h, p in cases])
    won = automaton.longest(*url_filters.byte_column(whole))
    assert [automaton.rules[i].text if i >= 0 else None for i in won] == [naive(h, p) for h, p in cases]


def test_url_rows(spark):
    rows = [(1, "HTTP://Ex.ORG/es/x?q"), (1, "HTTP://Ex.ORG/es/x?q"), (2, None), (3, "no scheme"), (None, "a://b.org#/x"), (4, "s://evil\0.org/")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    found = url_filters.filter_urls(df, [url_filters.Rule("block", "org", "/")], id_column="page_id").collect()
    assert sorted(map(str, found)) == sorted(map(str, found)) and len(found) == 6
    by = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in found}
    assert (1, "ex.org", "/es/x", "org/", "block") in by and (2, "", "", None, "allow") in by and (None, "b.org", "", None, "allow") in by
    assert url_filters.filter_urls(df.where("page_id > 9"), [], id_column="page_id").count() == 0


# --- quality ------------------------------------------------------------------------


def quality_docs(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(rng.randint(55, 300))]
        text = " ".join(words)
        if i % 40 == 0:
            text = " ".join(w + "###" for w in words)
        if i % 40 == 1:
            text = "\n".join(["same line here"] * 3 + ["\n".join(words[k : k + 3]) for k in range(0, len(words), 3)] + ["x y"] * 40)
        rows.append((i, text, rng.choice(["a", "a", "b", None]), rng.choice(["s", "t", None])))
    rows += [(1000, None, "a", "s"), (1001, "", "a", None), (1002, " \n\t", None, "s"), (1003, "one", "c", "d"), (5, rows[5][1], "a", "s"), (None, rows[6][1], "a", "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("kept", F.lit("clash")).withColumn("n_words", F.lit(1))


def test_quality_as_sql(spark):
    docs = quality_docs(spark)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    ours = sorted(map(str, (tuple(r) for r in quality.judged(docs, carry=["doc_id"]).collect())))
    theirs = con.execute(QUALITY_SQL).fetchall()
    assert ours == sorted(map(str, theirs))
    kept = {r[0]: r[-1] for r in theirs}
    assert not kept[40] and not kept[41] and kept[2] and kept[3]
    assert sum(not k for k in kept.values()) < 40
    every = quality.kept_documents(docs)
    assert every.columns == docs.columns and every.where("kept = 'clash'").count() == sum(kept_ for *_, kept_ in theirs)
    assert quality.judged(docs.where("doc_id < 0"), carry=["doc_id"]).count() == 0


def test_estimate_withstands_a_third_of_outliers(spark):
    rng = np.random.default_rng(0)
    clean = rng.normal([1000, 320, 0, 0, 0], [60, 10, 30, 30, 50], (400, 5))
    bad = rng.normal([2000, 500, 800, 600, 900], 20, (200, 5))
    rows = [("a", "s", *map(int, r)) for r in np.concatenate([clean, bad])]
    df = spark.createDataFrame(rows, "k1 string, k2 string, " + ", ".join(f"{x} long" for x in quality.X))
    found = quality.estimates(df).first()
    assert abs(found.m1 - 1000) < 30 and abs(found.m3) < 30


# --- decontamination ----------------------------------------------------------------


@pytest.mark.parametrize("part", [200_000, 3])
def test_windows_against_brute_force(spark, part, monkeypatch):
    monkeypatch.setattr(decontaminate, "PART_WINDOWS", part)
    rng = random.Random(2)
    vocabulary = ["Alpha", "beta", "ga-mma", "δέλτα", "x1"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(1, text(4)), (2, text(12)), (3, text(25)), (3, text(11)), (4, None), (5, " . "), (None, text(6))]
    docs = [(i, text(rng.randint(0, 400))) for i in range(40)] + [(50, None), (51, ""), (52, items[2][1] + " tail"), (53, items[0][1].upper()), (52, items[2][1] + " tail")]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    expected = []
    for i, t in docs:
        w, hit, seen = words(t), set(), set()
        for item, b in items:
            v = words(b)
            n = min(10, len(v))
            wins = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
            for k in range(len(w) - n + 1):
                if n and tuple(w[k : k + n]) in wins:
                    hit.update(range(k, k + n))
                    if item is not None:
                        seen.add(str(item))
        expected.append((i, len(w), len(hit), len(seen), hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest(), bool(hit)))
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("_n_words", F.lit("clash")).withColumn("_hit_at", F.lit(0))
    b = spark.createDataFrame(items, "item_id long, text string")
    found = [tuple(r) for r in decontaminate.find_windows(d.select("doc_id", "text"), b, text="text", part_windows=part).select("doc_id", "_n_words", F.size("_hit_at"), F.size("_hit_items")).collect()]
    assert sorted(found) == sorted(e[:4] for e in expected)
    assert sorted(tuple(r) for r in decontaminate.hit_counts(d, b).collect()) == sorted(expected)
    clean = decontaminate.clean_documents(d, b)
    assert clean.columns == d.columns and clean.count() == sum(not e[-1] for e in expected)
    assert decontaminate.hit_counts(d, b.where("item_id > 9")).where("contaminated").count() == 0


# --- Jaccard join -------------------------------------------------------------------


def jaccard_brute(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and 100 * c >= 80 * (len(sets[i]) + len(sets[j]) - c):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows)]


@pytest.mark.parametrize("salt, rounds", [(1000, 1), (2, 0)])
def test_components_against_brute_force(spark, salt, rounds, monkeypatch):
    monkeypatch.setattr(jaccard_groups, "PER_SALT", salt)
    monkeypatch.setattr(jaccard_groups, "PER_BLOCK", salt)
    monkeypatch.setattr(jaccard_groups, "HUB_ROUNDS", rounds)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(4))
    line = " ".join(word() for _ in range(9))
    texts = [None, "", " \t", "one", "ONE", "a b c", "a b c d"]
    for _ in range(12):
        base = [word() for _ in range(rng.randint(6, 90))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy) + (" " + line if rng.random() < 0.4 else ""))
    chain = [word() for _ in range(120)]
    for k in range(12):  # neighbours are similar, the ends are not
        texts.append(" ".join(chain[4 * k : 4 * k + 60]))
    texts += [texts[10], texts[10].upper(), texts[20]]
    ids = rng.sample(range(1000), len(texts))
    rows = list(zip(ids, texts, strict=True))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit("clash")).withColumn("_id", F.lit(1))
    found = sorted(tuple(r) for r in jaccard_groups.linked(docs).collect())
    assert found == sorted(jaccard_brute(rows))
    kept = jaccard_groups.one_of_each(docs.unionByName(docs.limit(5)))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for *_, c in found})
    assert jaccard_groups.linked(docs.where("doc_id < 0")).count() == 0


def test_texts_of_null_and_repeated_ids_stay_by_themselves(spark):
    rng = random.Random(14)
    prose = lambda: " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(60))
    first, second, orphans = prose(), prose(), prose()
    rows = [(1, first), (None, first + " tail"), (2, second), (3, second), (3, prose()), (4, prose()), (4, prose())]
    rows += [(None, prose()), (None, prose()), (None, orphans), (None, orphans), (None, orphans + " tail"), (5, ""), (5, " "), (5, None), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_digest", F.lit(1)).withColumn("a.b", F.lit(2))
    kept = jaccard_groups.one_of_each(docs)
    assert kept.columns == docs.columns
    found = [tuple(r) for r in kept.select("doc_id", "text").collect()]
    assert sum((r[1] or "").startswith(orphans) for r in found) == 1
    others = [r for i, r in enumerate(rows) if i not in (1, 3, 9, 10, 11, 15)]
    assert sorted(str(r) for r in found if not (r[1] or "").startswith(orphans)) == sorted(map(str, others))


def test_other_texts_of_a_copied_id_are_linked(spark):
    rng = random.Random(15)
    prose = lambda: " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(60))
    copied, of_null, of_nine = prose(), prose(), prose()
    rows = [(1, copied), (None, copied), (9, copied.upper()), (None, of_null), (5, of_null + " tail"), (9, of_nine), (7, of_nine + " tail"), (8, prose())]
    found = jaccard_groups.linked(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str(r.component_id) for r in found) == sorted(map(str, (1, 1, 1, 5, 5, 7, 7, 8)))


def test_least_labels(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101), (7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 102: 100}


# --- WARC ---------------------------------------------------------------------------


def test_archives_with_heads_inside_payloads(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE", 700)
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:9>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [(1, "u", None), (2, "u\r\nX: y", ""), (3, None, fake * 30), (4, "w", "é" * 600), (5, "w", "é" * 600), (7, "w", "é" * 600), (6, "s", "small"), (8, "s", "small"), (10, "f", "x" + fake), (11, "n", "WARC/1.1\r\n" * 200)]
    rows += [(20 + i, "v", fake * (i % 7) + "tail" * i) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("size", F.lit("clash"))
    path = warc.work_path(spark, "test-warc")
    warc.write(df.repartition(3), path)
    found = {r.page_id: r for r in warc.read(spark, path, with_payload=True).collect()}
    assert len(found) == len(rows)
    groups = {}
    for i, _, h in rows:
        data = (h or "").encode()
        if len(data) >= 1000:
            groups[data] = max(groups.get(data, i), i)
    for i, _, h in rows:
        data, r = (h or "").encode(), found[i]
        first = groups.get(data, i)
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert (r.record_type, r.refers_to) == (("response", None) if first == i else ("revisit", first))
        assert bytes(r.payload) == (data if first == i else b"")
    assert warc.round_trip(df.where("page_id < 0")).count() == 0
    ids = spark.createDataFrame([(None, "u", "z" * 2000), (None, "u", "z" * 2000)], "page_id long, url string, html string")
    assert [r.record_type for r in warc.round_trip(ids).collect()] == ["response", "response"]


def test_archives_of_long_records(spark, monkeypatch):
    text = "<p>" + "long page " * 5_000_000
    rows = [(0, "u", "a"), (1, "u" * 3_000_000, "b"), (2, "u", text), (3, None, "c" * 300_000), (4, "u", text), *((9 + i, "u", f"s{i}") for i in range(30))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    monkeypatch.setattr(warc, "FILE_BYTES", 1 << 20)
    found = {r.page_id: r for r in warc.round_trip(df).collect()}
    assert {i: found[i].payload_bytes for i, *_ in rows} == {i: len(h) for i, _, h in rows}
    assert (found[2].record_type, found[2].refers_to, found[4].record_type) == ("revisit", 4, "response")


def test_broken_archives_are_no_silent_loss(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(spark.createDataFrame([(i, "u", "x" * 900) for i in range(9)], "page_id long, url string, html string").coalesce(1), path)
    (file,) = (tmp_path / "w").glob("part-*")
    whole = file.read_bytes()
    damaged = tmp_path / "d.warc"
    for data in (whole[:-40], whole.replace(b"Content-Length", b"Content-Weight", 1), whole[:-2000] + b"WARC" + whole[-2000:]):
        damaged.write_bytes(data)
        with pytest.raises(ValueError, match="end before the file"):
            warc.read(spark, str(damaged))
    damaged.write_bytes(whole)
    assert warc.read(spark, str(damaged)).count() == 9


# --- HTML ---------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies, really, yes.</div>
<div class="page"><div class="post"><h2>Head &amp; line</h2><p>First <b>pa</b>ragraph,\n with commas, and  so on, and more words.
<p>Second one, not closed, but with text &eacute;nough.<ul><li>one<li>two</ul><script>var x="<p>no</p>";</script></div>
<aside>Beside, the, text, with, many, commas.</aside></div>
<section id="comments"><p>A reader, says, many, things, here, and there.</p></section><form>Mail <input></form><footer>(c)</footer>"""


def test_main_text(spark):
    text = "Head & line First paragraph, with commas, and so on, and more words. Second one, not closed, but with text énough. one two"
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "w", ""), (4, "x", "<div"), (5, "y", "plain, text"), (6, "z", "<article>a</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(0))
    found = [(r.page_id, r.text, r.n_chars) for r in html_text.extract(df).collect()]
    assert sorted(found) == sorted([(1, text, len(text))] * 2 + [(2, "", 0), (3, "", 0), (4, "<div", 4), (5, "plain, text", 11), (6, "a", 1)])
    assert html_text.extract(df.where("page_id > 9")).count() == 0


STORY = "<p>A first paragraph, with commas, and words.</p><p>A second one, as long, as the first.</p>"
TOLD = "A first paragraph, with commas, and words. A second one, as long, as the first."


@pytest.mark.parametrize(
    "name",
    ["class=overflow-hidden", "class='a hidden-xs'", "class='layout no-sidebar'", "class=has-sidebar", "class='post comments-open'", "class=social-science"]
    + ["id=search-results", "data-state='hidden'", "title='display:none'", "class=sidebar", "hidden"],
)
def test_names_do_not_drop_the_article(name):
    beside = "<div class='sidebar'><p>Ads, here.</p></div><div hidden><p>Not shown, now.</p></div>"
    talk = "<section id=comments>" + "<div><p>I, a reader, say, so, many, things, at, length, here.</p></div>" * 4 + "</section>"
    assert html_text.main_text(f"<body><div {name}><div>{STORY}</div></div><div class=ad><p>Buy.</p></div>") == TOLD
    assert html_text.main_text(f"<body><div {name}><article>{STORY}</article></div>{beside}{talk}") == TOLD
    assert html_text.main_text(f"<body><div {name}><h2>Title</h2></div>") == "Title"
    assert html_text.main_text(f"<body><div class=no-sidebar><div {name}><main>{STORY}</main></div>{beside}</div>") == TOLD
    assert html_text.main_text(f"<body><div class=a><div>{STORY}</div></div>{talk}{beside}") == TOLD


def test_less_than_signs_in_quoted_values():
    assert html_text.main_text(f"""<body><div><div>{STORY}</div><div class="sidebar" data-x="<p>a</p>"><p>Menu.</p></div></div>""") == TOLD
    assert html_text.main_text("""<p>One <a title="x < y" href='a>b'>two</a>, three.</p><script data-x='<'>no</script>""") == "One two, three."
    assert html_text.main_text("""<p>One <a title="x>two</a>, three.</p>""") == "One two, three."
    for page in ("""<a x="<b" y="<b" """ * 50_000, """<a x="<b" y="<b" """ * 50_000 + "<", """<a x="<b""" * 50_000, """<a x='<b" y=" """ * 50_000):
        html_text.main_text(page)


def test_long_and_deep_pages_end():
    for page in ("<div>" * 50_000 + "x, y", "<a '" * 50_000, "<p>a, b" * 50_000, "<!--" * 50_000, "</x>" * 50_000):
        html_text.main_text(page)


# --- BPE ----------------------------------------------------------------------------


def test_encoding_as_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.tokenizer_path())
    own = bpe.tokenizer(bpe.tokenizer_path())
    rng = random.Random(6)
    texts = ["", " ", "x" * 5000, "the" * 2000, "a<|endoftext|>B <|startoftext|>", "ΑΣ ΣΑΣ İx", "I've it's 12 ½ ²", "日本語" * 400, "é \u0301e\u0301", "😀" * 300]
    texts += ["".join(rng.choice("abcdeinthgo") for _ in range(3000)) for _ in range(10)]
    texts += ["".join(rng.choice("the qing'sé,.!1 ") for _ in range(300)) for _ in range(50)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(own.encode(text)) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_round_trip_as_the_library(spark, sf_dir):
    """Both digests of the query against the library's own ids and decoding."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.tokenizer_path())
    library.no_truncation()
    library.no_padding()
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(-1, None), (-2, ""), (-3, " \n"), (None, "a" * 5000), (-4, "word " * 60_000), (-4, "word " * 60_000), (-5, "x<|endoftext|><|startoftext|>é")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "body", "ids", "n_tokens")})
    found = {tuple(r) for r in bpe.round_trip(df).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    wanted = set()
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        wanted.add((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert found == wanted
    encoded = {(r.doc_id, tuple(r.ids)) for r in bpe.encode_column(df.drop("ids"), doc_id="doc_id").collect()}
    assert {(i, len(x)) for i, x in encoded} == {w[:2] for w in wanted}


def test_joined_decoder_takes_ids_in_any_lists():
    words = bpe.tokenizer(bpe.tokenizer_path())
    ids = [i for t in ("some plain words", "é<|endoftext|> 1 2") for i in words.encode(t)] + [10**9]
    for size in (1, 2, 5, 100):
        decoder = bpe.JoinedDecoder(words)
        assert "".join(decoder.feed(ids[i : i + size]) for i in range(0, len(ids), size)) == words.decode(ids)
    assert bpe.JoinedDecoder(words).feed([]) == ""


def test_sample_for_training_is_small_before_it_is_sorted(spark, monkeypatch):
    monkeypatch.setattr(pii, "SAMPLE_ROWS", 50)
    monkeypatch.setattr(pii, "ROUNDS", 1)
    seen = []
    monkeypatch.setattr(pii, "examples", lambda texts: seen.append(texts) or real(texts, many=8))
    texts = ["the same text"] * 3000 + [f"text number {i}" for i in range(3000)] + [None]
    pii.trained(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert 40 <= len(seen[0]) <= 50 and len(set(seen[0])) == len(seen[0])


real = pii.examples


def test_stream_holds_little_and_decoder_completes():
    own = bpe.tokenizer(bpe.tokenizer_path())
    decoder = bpe.Decoder(own)
    text = "naïve 日本 😀 x"
    assert "".join(map(decoder.feed, own.encode(text))) + decoder.finish() == "naïve 日本 😀 x "
    taken = 0

    def symbols():
        nonlocal taken
        for c in "thequickbrown" * 2000:
            taken += 1
            yield own.inner[ord(c)]

    stream = own.merges.stream(symbols(), own.length)
    made = 0
    for token in stream:
        made += own.length[token]
        assert taken - made <= bpe.CHUNK + 2 * own.merges.lookahead


def test_token_rows(spark):
    rows = [(1, "Hello hello"), (1, "Hello hello"), (2, None), (3, ""), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    empty = hashlib.sha256(b"").hexdigest()
    found = sorted(map(str, map(tuple, bpe.round_trip(df).collect())))
    assert sum(empty in r for r in found) == 2 and len(found) == 5
    assert [len(r.ids) for r in bpe.encode_column(df, doc_id="doc_id").orderBy("doc_id").collect()] == [1, 2, 2, 0, 0]


# --- personal data ------------------------------------------------------------------

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                kind == 0
                or (kind == 1 and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == 2 and 12 <= len(digits) <= 19 and pii.luhn(digits))
                or (kind == 3 and 9 <= len(digits) <= 15)
            )
            if good:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_patterns_as_regular_expressions():
    rng = random.Random(7)
    for _ in range(4000):
        text = "".join(rng.choice(["a", "@", ".", "-", "1", "0", "+", " ", "(", "12.3", "a@b.c", "4111111111111111", "+1 23"]) for _ in range(rng.randint(0, 25)))
        assert pii.pattern_spans(text) == plain_spans(text)


def test_gradients():
    rng = np.random.default_rng(1)
    model = Tagger(6, 3, units=3)
    codes, tags = rng.integers(0, 6, (7, 4)), rng.integers(0, 3, (7, 4))
    _, gradients = model.loss_and_gradients(codes, tags)
    for w, g in zip(model.weights, gradients, strict=True):
        for i in rng.integers(0, w.size, 4):
            w.flat[i] += 1e-2
            up = model.loss_and_gradients(codes, tags)[0]
            w.flat[i] -= 2e-2
            down = model.loss_and_gradients(codes, tags)[0]
            w.flat[i] += 1e-2
            assert abs((up - down) / 2e-2 - g.flat[i]) < 2e-2 + 0.05 * abs(g.flat[i])


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return pii.trained(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_held_out_accuracy(model, spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    codes, tags = pii.examples(texts, seed=1234, many=1500)
    found = model.best(model.scores(codes))
    assert (found == tags).mean() > 0.99
    assert (found[tags > 0] == tags[tags > 0]).mean() > 0.95


def test_pruned_decoding_is_exact(model):
    codes, _ = pii.examples(["some words, 12 of them"], seed=8, many=300)
    live, tags = model.tags(codes)
    whole = model.best(model.scores(codes))
    assert set(np.flatnonzero((whole > 0).any(axis=0))) == set(live)
    assert (whole[:, live] == tags).all()


def test_windows_do_not_matter(model, spark):
    text = "lorem ipsum dolor " * 14 + "call (555) 123-4567 or mail a.b [at] host [dot] org now " + "sit amet " * 60
    rows = [(i, "z" * i + " " + text) for i in range(0, 60, 7)] + [(1000, None), (1001, ""), (1001, ""), (None, "a@b.cc")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("clash")).withColumn("n_chars", F.lit(3))
    found = pii.find_spans(df, model=model).collect()
    kinds = {tuple(s.split(":")[0] for s in r.spans.split(",")) for r in found if r.doc_id is not None and r.doc_id < 1000}
    assert kinds == {("phone", "email")}
    assert [r.spans for r in found if r.doc_id in (1000, 1001)] == ["", "", ""]
    assert [(r.n_email, r.spans) for r in found if r.doc_id is None] == [(1, "email:0:6")]
    out = {r.doc_id: r.text for r in pii.redacted(df, model=model).collect()}
    assert "<phone>" in out[7] and "<email>" in out[7] and out[1000] is None and out[None] == "<email>"
    assert pii.find_spans(df.where("doc_id < -1"), model=model).count() == 0


def test_pieces_used_lately_outlive_a_full_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    own = bpe.WordBpe(bpe.tokenizer_path())
    anew, run = [], own.merges.run
    monkeypatch.setattr(own.merges, "run", lambda symbols, length: anew.append(len(symbols)) or run(symbols, length))
    # Two words in every text, and others that come once: the two are encoded once only.
    names = ["".join(chr(97 + (i // 26**k) % 26) for k in range(3)) for i in range(400)]
    words = [list(own.encode(f"netflix {name} subscription")) for name in names]
    assert len(anew) == len(set(names)) + 2 and len(own.cache) <= 50 and len(own.older) <= 50
    whole = bpe.tokenizer(bpe.tokenizer_path())
    assert words == [list(whole.encode(f"netflix {name} subscription")) for name in names]

import random
import re
import unicodedata
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from cadenza.functions.text import accent_table, char_grams, fold
from cadenza.operators import clusters
from cadenza.operators.rules import reset_blocked

START = date(2020, 1, 1)
SCHEMA = "user_account_id string, transaction_pending_id string, date date, counterparty string"


def grams(text):
    plain = "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))
    tokens = re.findall(r"(?u)\b\w\w+\b", plain)
    return set(tokens) | {f"{a} {b}" for a, b in zip(tokens, tokens[1:])}


def brute_force(rows):
    """Density clustering over all pairs of rows of each account."""
    out = {}
    for account in {r[0] for r in rows}:
        mine = sorted((r[2], r[1], grams(r[3])) for r in rows if r[0] == account)
        if not any(g for _, _, g in mine):
            out.update({(account, i): None for _, i, _ in mine})
            continue
        near = [
            [j for j, b in enumerate(mine) if a[2] and b[2] and 100 * len(a[2] & b[2]) ** 2 >= 49 * len(a[2]) * len(b[2])]
            for a in mine
        ]
        core = [len(n) >= 3 for n in near]
        number, clusters_found = {}, 0
        for i in range(len(mine)):
            if core[i] and i not in number:
                stack = [i]
                while stack:
                    k = stack.pop()
                    if k in number or not core[k]:
                        continue
                    number[k] = clusters_found
                    stack += near[k]
                clusters_found += 1
        for i, (_, key, _) in enumerate(mine):
            if i not in number:
                touching = [number[j] for j in near[i] if core[j]]
                out[account, key] = min(touching, default=-1)
            else:
                out[account, key] = number[i]
    return out


def ours(spark, rows, **kwargs):
    df = clusters.cluster_counterparties(spark.createDataFrame(rows, SCHEMA), **kwargs)
    return {(r.user_account_id, r.transaction_pending_id): r.counterparty_cluster for r in df.collect()}


@pytest.mark.parametrize("block", [256, 2])
def test_like_brute_force(spark, block):
    rng = random.Random(block)
    vocabulary = ["netflix", "com", "café", "Paris", "rent", "a", "shop", "42", "über", "x_1"]
    rows = []
    for i in range(160):
        account = f"acc{rng.randrange(3)}"
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 5)))
        rows.append((account, f"{i:03}", START + timedelta(days=rng.randrange(50)), text))
    rows += [("none", "n1", START, "a"), ("none", "n2", START, "b -"), ("none", "n3", START, "a")]
    assert ours(spark, rows, block=block) == brute_force(rows)


def test_crowd_of_near_copies(spark):
    """Many texts around one template, some bridges, and a node that is only
    near through the template."""
    rng = random.Random(9)
    template = "monthly card payment to the big store in london town".split()
    rows = []
    for i in range(40):
        words = template + [f"ref{i}"]
        if i % 5 == 0:
            words = words[1:]
        rows.append(("u", f"{i:02}", START + timedelta(days=rng.randrange(9)), " ".join(words)))
    rows += [("u", "x1", START, "monthly card payment"), ("u", "x2", START, " ".join(template[4:])), ("w", "y1", START, " ".join(template))]
    assert ours(spark, rows, block=3) == brute_force(rows) == ours(spark, rows)


def test_chain_of_near_copies_is_one_cluster(spark):
    """Components longer than one step, found by repeated rounds."""
    words = [f"w{i:02}" for i in range(40)]
    rows = [("u", f"{i:02}", START, " ".join(words[i : i + 9])) for i in range(30)]
    found = ours(spark, rows)
    assert found == brute_force(rows)
    assert set(found.values()) == {0}


def test_known_pairs(spark):
    rows = [("u", f"{i}", START, "netflix com") for i in range(3)] + [("u", "9", START, "small ring"), ("u", "8", START, "red ring")]
    found = ours(spark, rows)
    assert [found["u", str(i)] for i in range(3)] == [0, 0, 0] and found["u", "9"] == found["u", "8"] == -1


def test_blocking_rules(spark):
    rows = [
        ("Tesco", "TESCO BANK loan", 0),
        ("Tesco", "weekly shopping", -1),
        ("Landlord", "APPLE PAY rent", -1),
        ("Uber", "ride", -1),
        ("Landlord", None, 0),
        ("Tesco", None, -1),
        ("Post Office", "Insurance premium", 0),
        (None, "rent", 0),
    ]
    df = spark.createDataFrame([(*r, 0) for r in rows], "counterparty string, description string, wanted int, counterparty_cluster int")
    assert all(r.wanted == r.counterparty_cluster for r in reset_blocked(df).collect())


def test_folding_and_char_grams(spark):
    texts = ["Café DÉJÀ-VU", "Straße", "ÑANDÚ", "plain's \\ text", "ＦＵＬＬ"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", fold("t").alias("f"), fold("t", True).alias("g"))
    for r in df.collect():
        plain = "".join(c for c in unicodedata.normalize("NFKD", r.t.lower()) if not unicodedata.combining(c))
        assert r.f == plain == r.g
    wanted = {"net": {" net"}, "netflix": {" net", "netf", "etfl", "tfli", "flix", "lix "}}
    got = spark.createDataFrame([(w,) for w in wanted], "t string").select("t", char_grams("t").alias("g")).collect()
    # A padded word of five letters slides once.
    assert {r.t: set(r.g) for r in got} == {"net": {" net", "net "}, "netflix": wanted["netflix"]}
    one = spark.createDataFrame([("a bc",)], "t string").select(char_grams("t").alias("g")).first().g
    assert set(one) == {" a ", " bc "}
    assert len(accent_table()[0]) > 200


def test_bitmaps_bound_what_is_shared(spark):
    rng = random.Random(6)
    rows = [("a", str(i), [rng.randrange(-(2**63), 2**63) for _ in range(rng.randint(1, 60))]) for i in range(40)]
    rows += [("a", str(40 + i), rows[i][2][: len(rows[i][2]) // 2] + [rng.randrange(2**40) for _ in range(9)]) for i in range(40)]
    df = spark.createDataFrame([(a, n, sorted(set(g))) for a, n, g in rows], "user_account_id string, node string, grams array<long>")
    df = df.withColumn("n", F.size("grams").cast("long")).withColumns({name: clusters._bits(i) for i, name in enumerate(clusters.BITMAP)})
    pairs = df.alias("l").join(df.alias("h"), F.expr("l.node < h.node"))
    found = pairs.select(F.size(F.array_intersect("l.grams", "h.grams")).alias("shared"), clusters._most_shared("l", "h").alias("most"), F.least("l.n", "h.n").alias("n")).collect()
    assert all(r.shared <= r.most <= r.n for r in found)
    # The bound drops nearly all pairs that are no neighbours.
    assert sum(r.most > 0.7 * r.n for r in found) < 0.05 * len(found)


@pytest.mark.parametrize("block", [256, 2])
def test_pairs_are_looked_up_by_short_prefixes(spark, block):
    """All pairs of long texts are found, though only the shorter one's first 0.4 n grams are looked up."""
    rng = random.Random(12)
    base = [[f"w{rng.randrange(400):03}" for _ in range(60)] for _ in range(8)]
    texts = [" ".join(w for w in rng.choice(base) if rng.random() > 0.12) for _ in range(60)]
    texts += [" ".join(words[: rng.randrange(25, 61)]) for words in base for _ in range(3)]
    rows = [(f"acc{i % 2}", f"{i:03}", START, text) for i, text in enumerate(texts)]
    nodes = clusters.cut(clusters.gram_nodes(clusters.distinct_texts(spark.createDataFrame(rows, SCHEMA))))
    found = {(r.user_account_id, r.a, r.b, r.shared) for r in clusters.neighbour_pairs(nodes, block).collect()}
    sets = {}
    for account, key, day, text in rows:
        sets.setdefault((account, frozenset(grams(text))), f"{day}|{key}")
    wanted = {
        (a, min(x, y), max(x, y), len(g & h))
        for (a, g), x in sets.items()
        for (b, h), y in sets.items()
        if a == b and x < y and 100 * len(g & h) ** 2 >= 49 * len(g) * len(h)
    }
    assert found == wanted and len(wanted) > 20
    postings = clusters._postings(clusters.cut(clusters._entries(nodes, block)), block)
    assert not set(clusters.BITMAP) & set(postings.columns)
    short = postings.where("10 * rest >= 6 * n").select("id", "rest").distinct().count()
    assert short < 0.45 * sum(len(g) for _, g in sets)

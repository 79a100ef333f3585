import random

from hypothesis import given, settings
from hypothesis import strategies as st

from brightreel.llm import leakage, lookalike, packing, pii


def test_lookalikes():
    same = ["", "plain  text", "Façade – “quoted” ’s", "Письмо с маяка", "Η σιωπή του δάσους (Dubbed)", "最後の切符", "ليل المرفأ Fan Event", "夜の港　切符", "می‌خواهم", "👩‍👧"]
    assert [lookalike.normalise(x) for x in same] == same and lookalike.normalise(None) is None
    forms = {
        "Τhe Zigzag Jigsaw": "The Zigzag Jigsaw", "Th‌e S­even": "The Seven", "ｔｈｅ　ｄｕｓｔｙ": "the dusty", "𝖳𝗁𝖾 Foundry": "The Foundry", "Fac̦ade"[:3] + "̧ade": "Façade", "Crèche": "Crèche",
        "Chapter Ⅲ": "Chapter III", "ﬁne": "fine", "a b c": "a b c", "4‑K": "4-K", "Lumеn Tarrоwquaу 7": "Lumen Tarrowquay 7", "Part ІІ": "Part II", "Тихая гaвань": "Тихая гавань", "﻿": "",
    }
    assert {k: lookalike.normalise(k) for k in forms} == forms


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30))
def test_one_form(x):
    once = lookalike.normalise(x)
    assert lookalike.normalise(once) == once


def test_lookalike_table(spark):
    df = spark.createDataFrame([(1, "Lumеn", "x"), (1, "Lumеn", "x"), (2, None, "x"), (3, "", "x"), (4, "а" * 20_000 + "z", "x")], "i int, name string, text string")
    got = sorted(map(tuple, lookalike.normalised(df, "f", "i", "name").where("affected").select("row_id", "normal").collect()))
    assert got == [(1, "Lumen"), (1, "Lumen"), (4, "a" * 20_000 + "z")]


PII = [
    ("You can reach me at a.b+c@mail.example.org or call +1 (503) 555-0113 after six.", [("email", "a.b+c@mail.example.org"), ("phone", "+1 (503) 555-0113")]),
    ("cc jo_x [at] reel [dot] test The film. Meet me @ screen 5 around 6:40 pm.", [("email", "jo_x [at] reel [dot] test")]),
    ("Old mail jo @ reel.test bounces. Orbis 25 @ The Foundry. Tagged @Kipreels.", [("email", "jo @ reel.test")]),
    ("My name is Thora de la Ombrey and I live at 180B Cinder Rd.. Order 3394-7043-78, barcode 042729391949, #48502, $21.50.", [("name", "Thora de la Ombrey"), ("address", "180B Cinder Rd.")]),
    ("Signed, L. Quiroval, 284 YEWTREE WAY", [("name", "L. Quiroval"), ("address", "284 YEWTREE WAY")]),
    ("Invoice for Tolliver, Inés, 755 W. Fiddler Avenue. Kip said so.", [("name", "Tolliver, Inés"), ("address", "755 W. Fiddler Avenue")]),
    ("Found wallet, ID ID-056.123.726-9, holder RUAIRI GRIMSDALE.", [("id_number", "ID-056.123.726-9"), ("name", "RUAIRI GRIMSDALE")]),
    ("SSN 000-24-9202, passport no. Q79 066 658, licence X804-2123-1978, 27131204-B, ZZ3410069", [("id_number", x) for x in ("000-24-9202", "Q79 066 658", "X804-2123-1978", "27131204-B", "ZZ3410069")]),
    ("Me llamo Ilse Tannow y vivo en calle Elmgrove nº 861.", [("name", "Ilse Tannow"), ("address", "calle Elmgrove nº 861")]),
    ("Je m'appelle Noemi Nordesk et j'habite 689 bis rue Granary. Tél. 01 99 00 40 61", [("name", "Noemi Nordesk"), ("address", "689 bis rue Granary"), ("phone", "01 99 00 40 61")]),
    ("Ich heiße Odalys Valcourt und wohne Saffronstr. 276a.", [("name", "Odalys Valcourt"), ("address", "Saffronstr. 276a")]),
    ("According to the ledger, 31 tickets were exchanged at 7:40 pm. Row 12, seat 3.", []),
    ("", []), (None, []),
]


def test_personal_information():
    for text, want in PII:
        assert [(k, text[s:e]) for s, e, k in pii.find(text)] == want, text


def test_redaction(spark):
    df = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(PII)] + [(99, "no word " * 30_000 + "Signed, Ilse Oskell", "x")], "i int, t string, found string")
    got = {r.id: r for r in pii.redact(df, "i", "t").collect()}
    assert got[0].redacted == "You can reach me at <EMAIL> or call <PHONE> after six." and got[13].redacted is None and got[12].redacted == ""
    assert [tuple(x) for x in got[99].found] == [("name", "Ilse Oskell")] and got[99].redacted.endswith("Signed, <NAME>")
    assert pii.redact(df.limit(0), "i", "t").count() == 0


def brute_runs(doc, item, n=12):
    a, b = leakage.words(doc), leakage.words(item)
    runs = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)}
    return any(tuple(a[i : i + n]) in runs for i in range(len(a) - n + 1))


def test_myers():
    def plain(p, t):
        row = [0] * (len(t) + 1)
        for i, x in enumerate(p, 1):
            new = [i]
            for j, y in enumerate(t, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
            row = new
        return min(row)

    rng = random.Random(2)
    for _ in range(300):
        p, t = [rng.choice("abc") for _ in range(rng.randint(1, 9))], [rng.choice("abc") for _ in range(rng.randint(0, 15))]
        assert leakage.myers(p, t) == plain(p, t)


def test_leaks_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 60)))) for i in range(12)] + [(12, None), (13, ""), (14, "short one")]
    docs = []
    for d in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 80))]
        own = items[rng.randrange(12)][1].split()
        n = rng.choice([6, 10, 11, 12, 13, 25])
        s = rng.randint(0, max(0, len(own) - n))
        at = rng.randint(0, len(words))
        docs.append((d, "\n".join(words[:at] + [w.upper() + "," for w in own[s : s + n]] + words[at:]), "x"))
    docs += [(500, None, "x"), (501, "", "x"), (502, docs[3][1], "x")]
    d, i = spark.createDataFrame(docs, "d int, t string, item_id string"), spark.createDataFrame(items, "i int, x string")
    got = sorted((r.doc_id, r.item_id) for r in leakage.matches(d, "d", "t", i, "i", "x").where("run_words >= 12").collect())
    assert got == sorted((a, b) for a, t, _ in docs for b, x in items if brute_runs(t, x)) and got
    assert leakage.matches(d, "d", "t", i.limit(0), "i", "x").count() == 0 and leakage.matches(d.limit(0), "d", "t", i, "i", "x").count() == 0


def test_leak_with_an_error(spark):
    own = [f"u{i}" for i in range(14)]
    doc = own[:8] + ["other"] + own[9:]
    d, i = spark.createDataFrame([(1, " ".join(doc))], "d int, t string"), spark.createDataFrame([(7, " ".join(own))], "i int, x string")
    r = leakage.matches(d, "d", "t", i, "i", "x").collect()
    assert [(x.item_id, x.errors) for x in r] == [(7, 1)] and r[0].run_words < 12


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(leakage, "MAX_ITEMS", 3)
    items = [(i, " ".join(f"x{i}_{k}".replace("_", "q") for k in range(13))) for i in range(8)]
    d, i = spark.createDataFrame([(1, " ".join(t for _, t in items))], "d int, t string"), spark.createDataFrame(items, "i int, x string")
    assert sorted(r.item_id for r in leakage.matches(d, "d", "t", i, "i", "x").collect()) == list(range(8))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20), st.booleans())
def test_plan_packs_everything(histogram, top_up):
    bounds = packing.optimal_buckets(histogram, 4)
    plan = packing.plan_batches(histogram, 64, bounds, top_up)
    used = {}
    for need, times in plan:
        assert sum(x * n for x, n in need.items()) <= 64 and times > 0
        for x, n in need.items():
            used[x] = used.get(x, 0) + n * times
    assert used == histogram


def test_buckets_are_optimal():
    from itertools import combinations

    rng = random.Random(1)
    for _ in range(20):
        h = {x: rng.randint(1, 9) for x in rng.sample(range(1, 40), 8)}
        pad = lambda b: sum(n * (min(u for u in b if u >= x) - x) for x, n in h.items())
        best = min(pad((*c, max(h))) for c in combinations(sorted(h)[:-1], 2))
        assert pad(packing.optimal_buckets(h, 3)) == best


def test_pack(spark):
    texts = [(i, "word " * (i % 50), "x") for i in range(300)] + [(1000, "word " * 700, "x"), (1001, None, "x"), (1002, "", "x"), (7, "again", "x")] + [(2000 + i, "hot words", "x") for i in range(200)]
    df = spark.createDataFrame(texts, "id int, text string, rank string").repartition(6)
    out = packing.pack(df, "id", "text", capacity=128).toPandas()
    full = out.dropna(subset=["sequence_id"])
    room = full.groupby("sequence_id").n_tokens.sum()
    assert room.max() <= 128 and len(room) == -(-int(room.sum()) // 128) and set(out[out.sequence_id.isna()].id) >= {1001, 1002}
    assert len(out[out.id == 7]) == 2 and list(out[out.id == 1000].sort_values("piece").start_token) == [128 * k for k in range(len(out[out.id == 1000]))]
    assert len(full[full.id >= 2000]) == 200
    assert packing.pack(df.limit(0), "id", "text").count() == 0


def test_look_alikes_of_further_scripts():
    cases = {"Օrbis": "Orbis", "Lumeո": "Lumen", "Ꭺmber": "Amber", "siɡnal": "signal", "Երեւան": "Երեւան", "ᏣᎳᎩ": "ᏣᎳᎩ", "ᎳᎪ": "ᎳᎪ"}
    assert {k: lookalike.normalise(k) for k in cases} == cases

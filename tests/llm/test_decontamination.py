import random

from stayspark.llm import decontamination as deco

ITEM = "A train leaves Boston at 3.5 hours and Anna carries 12 kg of apples to Paris while Bob and Anna walk 7 miles over the old stone bridge"


def run(spark, docs, items):
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    return {(r["doc_id"], r["item_id"]): r for r in deco.contaminated(d, b).collect()}


def test_copies_and_parameters(spark):
    swapped = ITEM.replace("Boston", "Lisbon").replace("Anna", "Carla").replace("12 kg", "99 pounds").replace("3.5", "8").replace("Paris", "Rome").replace("Bob", "Dan").replace("7 miles", "2 km")
    mixed = ITEM.replace("Anna walk", "Zoe walk").replace("Boston", "Anna")
    docs = [(1, f"before it. {ITEM} and after"), (2, f"so, {swapped.lower()}"), (3, f"We saw that {swapped[2:]}"), (4, "nothing of the kind is here at all " * 30), (5, None), (6, ""), (7, f"We saw that {mixed[2:]}"), (8, "word " * 50000 + ITEM[:90]), (1, "a second row"), (None, ITEM)]
    got = run(spark, docs, [(10, ITEM), (11, "too short item"), (12, None), (13, "four words only here")])
    assert (1, 10) in got
    assert got[1, 10]["changed_slots"] == 0
    assert (3, 10) in got
    assert got[3, 10]["changed_slots"] >= 6
    assert (4, 10) not in got
    assert (7, 10) not in got
    assert (8, 10) in got
    assert {d for d, _ in got} <= {1, 2, 3, 8}


def test_short_items_match_whole(spark):
    got = run(spark, [(1, "Here are four words, only here."), (2, "four words only"), (3, "only four words")], [(13, "four words only here")])
    assert set(got) == {(1, 13)}


def test_empty_tables(spark):
    assert run(spark, [], [(1, ITEM)]) == {}
    assert run(spark, [(1, ITEM)], []) == {}


def test_windows_against_brute_force(spark):
    r = random.Random(8)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    items = [(k, " ".join(r.choices(words, k=r.randint(8, 30)))) for k in range(6)]
    docs = []
    for k in range(40):
        text = r.choices(words, k=r.randint(0, 50))
        if k % 2:
            own = r.choice(items)[1].split()
            at = r.randrange(len(own) - 5)
            text[len(text) // 2 : len(text) // 2] = own[at : at + r.randint(5, 20)]
        docs.append((k, " ".join(text)))
    want = set()
    for d, t in docs:
        runs = {tuple(t.split()[k : k + 8]) for k in range(len(t.split()) - 7)}
        for i, x in items:
            own = [tuple(x.split()[k : k + 8]) for k in range(len(x.split()) - 7)]
            n = len({k for k, w in enumerate(own) if w in runs})
            if n and n >= deco.SHARE * len(own):
                want.add((d, i, n))
    assert {(d, i, x["matched_windows"]) for (d, i), x in run(spark, docs, items).items()} == want
    joined = deco.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), broadcast_rows=0)
    assert joined.select("doc_id", "item_id").distinct().count() >= len({(d, i) for d, i, _ in want})

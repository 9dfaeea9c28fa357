import random

from linebeam.llm.bytehash import Powers
from linebeam.llm.decontam import COVERAGE, Words, contaminated

ITEM = ("If Anna buys 12 apples for 3 dollars each and sells 5 of them to Anna again for 7 dollars, "
        "how much money does Anna have left at the end?")
OTHER = ("If Boris buys 44 apples for 9 euros each and sells 6 of them to Boris again for 8 euros, "
         "how much money does Boris have left at the end?")
MIXED = OTHER.replace("to Boris", "to Carla").replace("does Boris", "does Dan")


def test_reparameterised_question_and_slots(spark):
    bench = spark.createDataFrame([(3, ITEM), (2, ITEM), (9, None), (10, "too short"), (11, "")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "Some words before. " + OTHER + " And after.", 0), (2, MIXED, 0), (None, ITEM, 0), (4, None, 0), (5, "", 0),
         (6, ITEM, 0), (6, ITEM, 0), (7, "x " * 30000 + ITEM, 0), (8, "nothing of the kind at all", 0)],
        "doc_id long, text string, key long")
    got = sorted(((r["doc_id"], r["item_id"]) for r in contaminated(docs, bench).collect()), key=str)
    assert got == [(1, 2), (6, 2), (7, 2), (None, 2)]
    assert contaminated(docs.limit(0), bench).collect() == [] and contaminated(docs, bench.limit(0)).collect() == []


def test_equals_brute_force_on_plain_words(spark):
    """Lower-case words without numbers: windows are plain five-word shingles."""
    rnd = random.Random(4)
    word = lambda: f"{rnd.choice('bcdfg')}{rnd.choice('aeiou')}{rnd.choice('klmnr')}{rnd.choice('aeiou')}x"
    items = [(i, [word() for _ in range(rnd.randrange(6, 40))]) for i in range(30)]
    docs = []
    for d in range(200):
        t = [word() for _ in range(rnd.randrange(0, 200))]
        if d % 3 == 0:
            _, w = rnd.choice(items)
            part = w[: rnd.randrange(3, len(w) + 1)]
            at = rnd.randrange(len(t) + 1)
            t[at:at] = part
        docs.append((d, t))
    want = set()
    for d, t in docs:
        for i, w in items:
            wins = {tuple(w[k:k + 5]): k for k in range(len(w) - 4)}
            hits = {}
            for p in range(len(t) - 4):
                if tuple(t[p:p + 5]) in wins:
                    hits.setdefault(p - wins[tuple(t[p:p + 5])], set()).add(wins[tuple(t[p:p + 5])])
            if any(len(s) >= COVERAGE * (len(w) - 4) for s in hits.values()):
                want.add((d, i))
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    f = spark.createDataFrame([(d, " ".join(t)) for d, t in docs], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(f, b).collect()} == want


def test_words_of_a_block():
    w = Words(["Hello, World 12km! Éa “x” --- (Foo) İx", None, "", "and Bar."], Powers())
    kinds = dict(zip([w.low[a:b + 1].decode() for a, b in zip(w.first, w.last)], w.kind.tolist()))
    assert kinds["hello"] == 0 and kinds["world"] == 3 and kinds["12km"] == 1 and kinds["bar"] == 3 and kinds["and"] == 0
    assert w.text.tolist()[-2:] == [3, 3] and set(w.text.tolist()) == {0, 3}


def test_items_that_repeat_a_template(spark):
    """Matches between the repetitions stand off the diagonal; they may not spoil the passage's slots."""
    item = ("At the market he buys 3 red apples, then he buys 4 red apples, then he buys 5 red apples. "
            "How many red apples does he have?")
    other = item.replace("3", "14").replace("4 red apples, then he buys 5", "25 red apples, then he buys 36")
    crossed = item.replace("3 red", "9 blue").replace("buys 4", "got 9").replace("buys 5", "lost 9").replace("many", "few")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, item), (2, "So: " + other), (3, crossed), (4, f"{item} {item}")], "doc_id long, text string")
    got = {r["doc_id"]: (r["windows"], r["item_windows"]) for r in contaminated(docs, bench).collect()}
    assert got == {1: (23, 23), 2: (23, 23), 4: (23, 23)}   # 27 words


def test_short_and_number_heavy_items(spark):
    """Too few usable windows: the whole item, with its own values; a common phrase is no evidence."""
    items = ["What is 12 + 5 * 3 - 7?", "Calculate 3/4 of 120 km.", "Name the largest planet.", "Why not?",
             "What is the value of 3 + 4 * 5?", "What is the value of 9?", "?!", "1 2 3 4 5 6 7 8 9 10 11"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = {100 + i: t for i, t in enumerate(items)} | {
        1: "Q: what is 12 +  5 * 3 - 7 ? A: 20", 2: "What is 12 * 5 + 3 - 7?", 3: "What is 12 + 5 * 3 - 8?", 4: "please (calculate 3/4 of 120 km) now",
        5: "Calculate 3/4 of 121 km.", 6: "He asked to name the largest planet, I think.", 7: "One can see why not? is odd", 8: "Yes!\n- why not\nno",
        9: "Nobody knew what is the value of 12 old coins.", 10: "Tell me what is the value of 6 + 7 * 8 today", 11: "so what is the value of 9",
        12: "Well. Why not? Go on"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, bench).collect()}
    assert got == ({(100 + i, i) for i in range(8) if i != 6} | {(1, 0), (4, 1), (6, 2), (8, 3), (12, 3), (10, 4), (11, 5)})
    r = contaminated(docs.where("doc_id = 1"), bench).first()
    assert (r["windows"], r["item_windows"], r["coverage"]) == (1, 1, 1.0)

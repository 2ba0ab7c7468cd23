"""Decontamination of items of a few words: word for word and telling, or nothing."""

import random

from tillsight.llm.decontaminate import contaminated

COMMON = "what is the of a to and no in that it was for on are as with".split()


def test_short_items(spark):
    rng = random.Random(5)
    rare = [f"w{i}" for i in range(3000)]
    text = lambda n: [rng.choice(COMMON) if rng.random() < 0.6 else rng.choice(rare)
                      for _ in range(n)]
    docs = [(i, " ".join(text(150))) for i in range(60)]
    items = [(1, "no", None), (2, "what is the", None), (3, "capital kiribati tarawa atoll", None),
             (4, "who was it", "ludwig boltzmann"), (5, "zymurgy", None), (6, "", None)]
    plants = {100: "Capital Kiribati: tarawa atoll", 101: "who was it ? ludwig boltzmann",
              102: "who was it in the end", 103: "tarawa kiribati atoll capital", 104: "zymurgy no"}
    for i, plant in plants.items():
        words = text(120)
        words[50:50] = plant.split()
        docs.append((i, " ".join(words)))
    got = contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                       spark.createDataFrame(items, "item_id long, text string, answer string"),
                       answer="answer").collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(100, 3), (101, 4)]

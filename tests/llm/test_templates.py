from tests.llm.conftest import prose
from waymark.llm import templates


def test_short_items_openers_units_and_values(documents, spark):
    items = ["What is the capital of France?", "Alice has 3 apples. Bob gives her 5 more. How many apples does Alice have?", "12 km 34 kg 56 min 78 s and 90 m 11 ft 12 yd 13 mi or 14 cm", "so a man in a boat may take a second or a day in may"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"{prose(k, 30)}. {t} {prose(50 + k, 30)}" for k, t in enumerate(items)]
    texts[1] = texts[1].replace("Alice", "Carol").replace("Bob", "Dan").replace("3 apples", "8 apples").replace("5 more", "2 more")
    texts += [texts[1].replace("does Carol", "does Erin"), texts[2].replace("34", "35").replace("78", "79").replace("11", "17"), "What is the capital", prose(7, 90)]
    found = templates.leaks(documents(texts), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found if r.doc_id != 4} == {(k, k) for k in range(4)}

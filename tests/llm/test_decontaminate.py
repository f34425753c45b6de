import re

from footfall.llm import decontaminate


def plain_set(text):
    own = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(own[i:i + 5]) for i in range(len(own) - 4)} or ({tuple(own)} if own else set())


def brute(docs, items):
    sets = {r.item_id: plain_set(r.text) for r in items.collect()}
    out = []
    for row in docs.select("doc_id", "text").collect():
        own = plain_set(row.text)
        for item, wanted in sets.items():
            shared = len(own & wanted)
            if wanted and 100 * shared >= 75 * len(wanted):
                out.append((row.doc_id, item, shared, len(wanted)))
    return sorted(out)


def test_equals_brute_force(spark, sf, documents, monkeypatch):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    wanted = brute(documents, items)
    found = decontaminate.contamination(documents, items)
    assert sorted(tuple(r)[:4] for r in found.collect()) == wanted and wanted
    assert found.where("containment < 0.75 or containment > 1").isEmpty()
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", 100)
    assert sorted(tuple(r)[:4] for r in decontaminate.contamination(documents, items).collect()) == wanted


def test_partial_shouted_and_punctuated(spark):
    item = [f"w{i}" for i in range(44)]
    other = "lorem ipsum dolor sit amet consectetur " * 50
    def inside(n):
        return other + " ".join(item[:n]) + " " + other
    docs = spark.createDataFrame([
        (1, inside(44)), (2, inside(34)), (3, inside(33)), (4, inside(44).upper()), (5, "!! ".join(inside(44).split())),
        (6, other)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = {r.doc_id: r.n_shared for r in decontaminate.contamination(docs, items).collect()}
    assert found == {1: 40, 2: 30, 4: 40, 5: 40}
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()) == [3, 6]


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "ONE two three four"), (None, "no id here at all none"),
                                   (3, "ONE two three four")], "item_id long, text string")
    found = decontaminate.contamination(odd_docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id or 0) for r in found) == [(0, 0)] + [(5, 3)] * 2 + [(6, 3)] * 4
    rest = decontaminate.drop_contaminated(odd_docs, items)
    assert rest.columns == odd_docs.columns
    assert sorted(r.doc_id for r in rest.collect()) == [1, 2, 3, 4, 7, 8, 9, 10]
    assert decontaminate.contamination(no_docs, items).count() == 0
    assert decontaminate.contamination(odd_docs, items.where("false")).count() == 0
    assert decontaminate.drop_contaminated(odd_docs, items.where("false")).count() == odd_docs.count()

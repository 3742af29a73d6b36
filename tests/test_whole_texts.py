from sparkloom.operators.inpaint import KINDS
from sparkloom.plans import catalog


def test_masks_and_captions_reach_the_end_of_long_texts(spark, tmp_path):
    rows = [(i, f"start {'word ' * (100 * i)}end{i}", i) for i in range(1, 21)]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t, _ in rows], "doc_id long, text string, n_chars int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    masks = {r["id"]: len(r["mask"]) for r in catalog.QUERIES["inpaint_masks"](spark, str(tmp_path)).collect()}
    assert masks == {i: len(t) for i, t, _ in rows}
    prompts = {r["doc_id"]: r["prompt"] for r in catalog.QUERIES["caption_conditions"](spark, str(tmp_path)).collect()}
    assert len(prompts) == 20 and all(f"end{i}" in p for i, p in prompts.items())
    assert {r["kept"] for r in catalog.QUERIES["interval_mask"](spark, str(tmp_path)).collect()} == {110}


def test_masks_of_empty_texts_hold_like_all_others(spark, tmp_path):
    docs = spark.createDataFrame([(i, "" if i % 2 else "word", 4 * (1 - i % 2)) for i in range(60)], "doc_id long, text string, n_chars int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kinds = {(r["kind"], len(r["mask"])) for r in catalog.QUERIES["inpaint_masks"](spark, str(tmp_path)).collect()}
    assert kinds == {(k, n) for k in KINDS for n in (0, 4)}
    rows = catalog.QUERIES["inpaint_properties"](spark, str(tmp_path)).collect()
    assert {r["id"]: r["length"] for r in rows} == {i: 4 * (1 - i % 2) for i in range(60)}
    assert all(r["known_kind"] and r["only_bits"] and r["some_hidden"] and r["shape"] for r in rows)

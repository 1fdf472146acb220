from linkscore.llm import mixing, ngram_join, repeats
from linkscore.llm.keys import row_key

ROWS = [
    (None, "x"), ("x", None), ("", "x"), ("x", ""), (None, None), ("", ""), ("1", "2:ab"), ("12:a", "b"), ("-", "x"), ("1:x", "-"),
]
SCHEMA = "doc_id string, text string, source string, key long"


def table(spark, rows):
    return spark.createDataFrame([(a, b, "s", 1) for a, b in rows], SCHEMA)


def test_keys_tell_rows_apart(spark):
    keys = [bytes(r[0]) for r in table(spark, ROWS).select(row_key()).collect()]
    assert len(set(keys)) == len(ROWS) and {len(k) for k in keys} == {16}
    again = [bytes(r[0]) for r in table(spark, ROWS).select(row_key()).collect()]
    assert again == keys


def test_a_null_id_is_no_null_text(spark):
    text = "".join(chr(97 + (k * k + k // 7) % 25) for k in range(900))
    df = table(spark, [(None, text), (text, None), ("other", text)])
    cut = {r["doc_id"]: (r["n_bytes"], len(r["spans"])) for r in repeats.remove_repeats(df).collect()}
    assert cut == {None: (900, 1), text: (0, 0), "other": (900, 1)}
    near = ngram_join.near_classes(df).collect()
    assert len({bytes(r["row_key"]) for r in near}) == 3 and len({bytes(r["class_key"]) for r in near}) == 2
    assert len({bytes(r["row_key"]) for r in mixing.mix(df).collect()}) == 3

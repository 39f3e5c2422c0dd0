from pyspark.sql import functions as F

from locusframe.functions import text
from locusframe.sources import documents


def test_keys_are_read_with_their_escapes(spark):
    long = '{"v": "' + '\\"' * 100_000 + '", "api\\u005fkey": 1}'
    rows = [('{"api\\u005fkey": 1, "n": [{"pass\\u0077ord" : "\\"secret\\": x"}]}',), ('{"v": ["x", ": y", "\\\\"], "a\\"b": {"c": 1}}',), (long,)]
    got = spark.createDataFrame(rows, "j string").select(text.json_key_names(F.col("j")).alias("k")).collect()
    assert [r.k for r in got] == [["api_key", "n", "password"], ["v", 'a"b', "c"], ["v", "api_key"]]


def test_a_document_beyond_the_parser_is_too_large(spark):
    limit = spark.sparkContext._jvm.org.apache.spark.types.variant.VariantUtil.SIZE_LIMIT
    assert limit == documents.VARIANT_LIMIT
    # an array longer than the limit, a string longer than any reader takes, a broken text without one; small texts
    ten = F.concat(F.lit('"'), F.repeat(F.lit("x"), F.lit(10_000_000)), F.lit('"'))
    long = F.concat(F.lit("["), F.repeat(F.concat(ten, F.lit(",")), F.lit(13)), ten, F.lit("]"))
    one = F.concat(F.lit('["'), F.repeat(F.lit("x"), F.lit(documents.STRING_LIMIT + 1)), F.lit('"]'))
    torn = F.concat(F.lit("["), ten, F.lit(","), ten, F.lit(","), ten)
    want = {"long": "too_large", "one": "too_large", "torn": "malformed", "twice": "duplicate_key", "good": None}
    texts = {"long": long, "one": one, "torn": torn, "twice": F.lit('{"a": 1, "a": "x"}'), "good": F.concat(F.lit("["), ten, F.lit("]"))}
    for name, body in texts.items():
        got = spark.range(1).select(F.when(F.col("id") == 0, body).alias("t")).select(documents.json_violation(F.col("t")).alias("v")).first()
        assert got.v == want[name], name

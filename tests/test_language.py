import pytest
from pyspark.sql import functions as F

from newslake.operators.language import detect_language, load_profiles, train_lang_profiles

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def test_accuracy_on_held_out_rows(spark, documents, tmp_path):
    profiles = train_lang_profiles(documents.where("doc_id % 2 = 0"))
    profiles.write.parquet(str(tmp_path / "profiles"))
    model = load_profiles(spark.read.parquet(str(tmp_path / "profiles")))
    held_out = documents.where("doc_id % 2 = 1 AND length(text) >= 20")
    tagged = detect_language(held_out, model, F.col("text"))
    right, n = tagged.agg(F.count_if(F.col("langue") == F.col("lang")), F.count("*")).first()
    assert right / n > 0.98


def test_undecidable_samples(spark, documents):
    model = load_profiles(train_lang_profiles(documents))
    samples = [("a" * 19,), ("a" * 20,), ("1234567890 1234567890",), (None,), ("",)]
    df = spark.createDataFrame(samples, "s string")
    assert [r.langue is None for r in detect_language(df, model, F.col("s")).collect()] == [True, False, True, True, True]


def test_training_does_not_depend_on_partitioning(documents):
    def profile(df):
        return sorted(map(tuple, train_lang_profiles(df).collect()))

    assert profile(documents.coalesce(1)) == profile(documents.repartition(7))

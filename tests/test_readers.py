"""File readers: declared types, no inference."""

from larkspur.functions.columns import binary_label, flags
from larkspur.plans import classify, recommend
from larkspur.sources import readers, sinks
from pyspark.sql import functions as F


def write(path, text):
    path.write_text(text)
    return str(path)


def test_bit_vectors(spark, tmp_path):
    path = write(tmp_path / "bits.csv", "0,1,1,-1\n1,1,0,1\n")
    rows = readers.bit_vectors(spark, path, bits=3)
    assert rows.dtypes == [(f"_c{i}", "tinyint") for i in range(4)]
    typed = classify.typed_vectors(rows, "_c3")
    assert [r.labels for r in typed.collect()] == [0.0, 1.0]
    assert len(readers.bit_vectors(spark, path).columns) == 129


def test_ratings_and_tags(spark, tmp_path):
    ratings = readers.ratings(
        spark, write(tmp_path / "r.csv", "userId,movieId,rating,timestamp\n1,296,5.0,1147880044\n")
    )
    assert ratings.dtypes == [
        ("userId", "bigint"), ("movieId", "bigint"), ("rating", "double"), ("timestamp", "string")
    ]
    assert tuple(ratings.first()) == (1, 296, 5.0, "1147880044")
    scores = readers.tag_scores(
        spark, write(tmp_path / "s.csv", "movieId,tagId,relevance\n1,2,0.0287\n")
    )
    names = readers.tag_names(spark, write(tmp_path / "n.csv", "tagId,tag\n2,noir\n"))
    assert tuple(scores.first()) == (1, 2, 0.0287)
    assert tuple(names.first()) == (2, "noir")
    raw = spark.createDataFrame([("1", "2", "3.5"), ("x", "2", "")],
                                "user_id string, item_id string, rating string")
    assert [tuple(r) for r in recommend.typed_ratings(raw).collect()] == [
        (1, 2, 3.5), (None, 2, None)
    ]


def test_encounters(spark, tmp_path):
    drugs = readers.DRUG_COLUMNS
    assert len(drugs) == 23
    header = ["encounter_id", *drugs, readers.STAY, readers.READMITTED]
    rows = [["1", *["No"] * 23, "3", "NO"], ["2", "Up", *["no"] * 22, "4", "<30"],
            ["3", *["No"] * 23, "9", ">30"]]
    path = write(tmp_path / "e.csv", "\n".join(",".join(r) for r in [header, *rows]) + "\n")
    got = readers.encounters(spark, path)
    assert "encounter_id" not in got.columns and dict(got.dtypes)[readers.STAY] == "int"
    encoded = got.select(
        *flags({f"{d}": "No" for d in drugs if "-" not in d}),
        binary_label(F.col(readers.READMITTED), "NO").alias("label"),
    ).collect()
    assert [r.label for r in encoded] == [0.0, 1.0, 1.0]
    assert [r.metformin for r in encoded] == [0, 1, 0]
    assert [r.insulin for r in encoded] == [0, 1, 0]


def test_all_drug_columns_encode(spark, tmp_path):
    """Column names with a hyphen go through the same flag and vector steps."""
    from larkspur.plans import tabular

    drugs = readers.DRUG_COLUMNS
    rows = spark.createDataFrame(
        [("No",) * 22 + ("Up", "NO", 2), ("Up",) * 23 + ("<30", 5)],
        ", ".join(f"`{d}` string" for d in drugs) + ", readmitted string, stay int",
    )
    encoded = tabular.encode(rows, {d: "No" for d in drugs}, "readmitted", "NO", ["stay"])
    vectors = tabular.assemble(tabular.collapse(encoded, encoded.columns), drugs)
    sums = sorted((r.label, float(sum(r.features.toArray()))) for r in vectors.collect())
    assert sums == [(0.0, 1.0), (1.0, 23.0)]


def test_results_append_side_by_side(spark, tmp_path):
    path = str(tmp_path / "results")
    for value in (1.0, 2.0):
        sinks.append_results(spark.createDataFrame([("a", value)], "k string, v double"), path)
    assert spark.read.parquet(path).count() == 2
    table = str(tmp_path / "table")
    sinks.write_csv(spark.createDataFrame([("a", 1.0)], "k string, v double"), table)
    assert tuple(spark.read.option("header", True).csv(table).first()) == ("a", "1.0")

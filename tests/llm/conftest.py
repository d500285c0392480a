import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty and very long texts, repeated rows and columns with the operators' own names."""
    words = " ".join(f"word{i % 977}" for i in range(40_000))
    rows = [
        (0, "A plain text with mail to some.one@mail.example.com and more.", "en", "a", 60),
        (1, None, "en", "a", None),
        (2, "", None, None, 0),
        (3, " \n\t ", "en", "a", 4),
        (4, words, "en", None, len(words)),
        (5, "Ein Text, der zweimal vorkommt und gleich ist.", "de", "b", 46),
        (5, "Ein Text, der zweimal vorkommt und gleich ist.", "de", "b", 46),
        (None, "A row without a number, 10.0.0.1 in it.", "en", "a", 39),
        (None, None, None, None, None),
        (6, "12 34 ... !!!", "fr", "b", 13),
        (7, "été à la plage \U0001f600 +1 (268) 555-6289 fin", "fr", "b", 41),
    ]
    clashing = ["block", "cls", "spans", "score", "kept", "n_tokens", "component_id", "__text_", "start", "length"]
    clashing += ["base_email", "wide_ip", "all_card", "added_phone", "__text", "__spans", "__rows", "__kept", "id", "row", "repeated"]
    columns = SCHEMA + "".join(f", {name} string" for name in clashing)
    return spark.createDataFrame([(*r, *(["x"] * len(clashing))) for r in rows], columns)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

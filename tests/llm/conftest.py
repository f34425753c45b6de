import os
import re

import pytest

from tests.conftest import SF

ODD = [  # nulls, empty, blank, short, long, repeated
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, "one", "en", "b"),
    (5, "one two three four", "en", "b"), (6, "one two three four", "fr", "b"), (6, "one two three four", "fr", "b"),
    (None, "no id here at all, none", "en", "a"), (7, "word " * 30_000, "en", None), (8, "x" * 50_000, "en", "a"),
    (9, "1234 5678 !!! ###", "en", "z"), (10, "Ünï çödé  text", "de", "z")]


@pytest.fixture(scope="session", autouse=True)
def shared(spark, tmp_path_factory):
    if not spark.sparkContext.getConf().get("spark.checkpoint.dir", ""):
        spark.conf.set("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Awkward rows, with a column of a type and name that operators might use themselves."""
    return spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string").selectExpr(
        "*", "array(1, 2) AS score", "'x' AS size", "3 AS row_id")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(os.path.join(SF, "documents.parquet"))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text):
    own = words(text)
    return {tuple(own[i:i + 5]) for i in range(len(own) - 4)} or ({tuple(own)} if own else set())

"""A real text file read with spark.read.text equals the column form."""

from pyspark.sql import functions as F

from streamledger.functions.text import text_lines
from streamledger.operators import counts
from streamledger.session import load_table
from streamledger.sources.text import read_lines, write_lines
from tests.conftest import SF_SMALL


def test_text_file_lines_equal_column_lines(spark, workdir):
    docs = load_table(spark, SF_SMALL, "documents")
    write_lines(docs, "text", f"{workdir}/docs.txt")
    from_file = read_lines(spark, f"{workdir}/docs.txt")
    from_col = docs.select(F.explode(text_lines("text")).alias("value"))
    a = from_file.groupBy("value").count()
    b = from_col.groupBy("value").count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # A4/A5 over the file equal the same over the column
    s_file = counts.length_summary(counts.token_lengths(from_file, "value")).first()
    s_col = counts.length_summary(counts.token_lengths(docs, "text")).first()
    assert (s_file["num"], s_file["total"]) == (s_col["num"], s_col["total"])

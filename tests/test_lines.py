import random

from notelake.operators.metrics import line_metrics

EDGES = ["", "a", "a\n", "\n", "\n\n", "a\r\nb", "a\r\n", "\r", "\r\r\n\n", "a\x85b\n", "a b", "a ",
         "\x1c", "a\x1fb", " \xa0\n　\n", "%%time\nx", "  !ls\n\t%x\n\xa0%y\n x % y", "\x0b\x0c",
         "%a\n%b\n", "\n%a\n\n"]


def expected(text):
    lines = text.splitlines()
    magic = [line.lstrip().startswith(("%", "!")) for line in lines]
    return (len(lines), sum(line.strip() == "" for line in lines), sum(magic),
            "\n".join(line for line, skip in zip(lines, magic) if not skip))


def test_lines_are_those_of_python(spark):
    rng = random.Random(7)
    marks = ["\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", " ",
             " ", " ", "\t", "\xa0", "　", "%", "!", "a", "é", "#"]
    texts = EDGES + ["".join(rng.choices(marks, k=rng.randrange(12))) for _ in range(400)]
    cells = spark.createDataFrame(list(enumerate(texts)), "i int, source string")
    for row in line_metrics(cells).collect():
        assert (row.LOC, row.BLC, row.MSC, row.code) == expected(texts[row.i]), repr(texts[row.i])


def test_missing_source_is_empty(spark):
    row = line_metrics(spark.createDataFrame([(None,)], "source string")).first()
    assert (row.LOC, row.BLC, row.MSC, row.code) == (0, 0, 0, "")

from sprout.sources.lines import encode_labelled, parse_lines

GOLDEN = [("A B+", "A B", 1), ("A B-", "A B", -1), ("A B0", "A B", 0), ("A B", "A ", 0), ("", "", 0)]


def test_parse_golden(spark):
    df = spark.createDataFrame([(v,) for v, _, _ in GOLDEN], "value string")
    got = [(r.text, r.label) for r in parse_lines(df).collect()]
    assert got == [(t, l) for _, t, l in GOLDEN]


def test_parse_three_char_strip(spark):
    df = spark.createDataFrame([("the bank .+",), ("ab",)], "value string")
    got = [(r.text, r.label) for r in parse_lines(df, strip_chars=3).collect()]
    assert got == [("the bank", 1), ("", 0)]


def test_encode_roundtrip(spark):
    df = spark.createDataFrame([("x y", 1), ("x", -1), ("z", 0)], "text string, label int")
    lines = encode_labelled(df)
    assert [r.value for r in lines.collect()] == ["x y+", "x-", "z0"]
    assert [(r.text, r.label) for r in parse_lines(lines).collect()] == [("x y", 1), ("x", -1), ("z", 0)]


def test_text_file_roundtrip(spark, tmp_path):
    from sprout.sources.lines import read_labelled_lines, write_labelled_lines
    df = spark.createDataFrame([("x y", 1), ("x", -1), ("z", 0)], "text string, label int")
    write_labelled_lines(df, str(tmp_path / "lines"))
    got = sorted((r.text, r.label) for r in read_labelled_lines(spark, str(tmp_path / "lines")).collect())
    assert got == [("x", -1), ("x y", 1), ("z", 0)]


def test_line_index_follows_file_order(spark, tmp_path):
    from sprout.sources.lines import read_labelled_lines
    from sprout.session import scoped_conf
    path = tmp_path / "one.txt"
    lines = [f"line number {i} " + "x" * (i % 37) + "+-0"[i % 3] for i in range(3000)]
    path.write_text("\n".join(lines) + "\n")
    with scoped_conf(spark, {"spark.sql.files.maxPartitionBytes": "4096",
                             "spark.sql.files.openCostInBytes": "0"}):
        df = read_labelled_lines(spark, str(path), index=True)
        assert df.rdd.getNumPartitions() > 5
        got = sorted((r.sent_id, r.text, r.label) for r in df.collect())
    assert [g[0] for g in got] == list(range(3000))
    assert [g[1] for g in got] == [l[:-1] for l in lines]
    assert [g[2] for g in got] == [{"+": 1, "-": -1}.get(l[-1], 0) for l in lines]

"""Code-dictionary parsing: whole blocks, every line shape, split-robust."""

import pytest
from hypothesis import given, settings, strategies as st

from starloom.sources import labels as lb
from starloom.sources.files import read_text_lines
from tests import fixtures as fx


@pytest.fixture(scope="module")
def dict_path(tmp_path_factory):
    p = tmp_path_factory.mktemp("dict") / "labels.txt"
    p.write_text(fx.DICTIONARY)
    return str(p)


def _entries(spark, path):
    return lb.code_labels(spark, path)


def test_block_sizes_and_first_entries(spark, dict_path):
    e = _entries(spark, dict_path)
    counts = {r.fmt: r["count"] for r in e.groupBy("fmt").count().collect()}
    assert counts == {lb.COUNTRY_FMT: len(fx.COUNTRIES), lb.PORT_FMT: len(fx.PORTS),
                      lb.MODE_FMT: fx.N_MODES, lb.STATE_FMT: fx.N_STATES}


def test_comment_map_not_parsed(spark, dict_path):
    labels = {r.label for r in _entries(spark, dict_path).collect()}
    assert "Trips" not in labels and "Leisure" not in labels


def test_countries(spark, dict_path):
    got = {r.country_code: r.country_name
           for r in lb.countries(_entries(spark, dict_path)).collect()}
    assert got == fx.COUNTRIES


def test_ports_city_and_state(spark, dict_path):
    e = _entries(spark, dict_path)
    got = {r.port_code: (r.city, r.state_code) for r in lb.ports(e, lb.states(e)).collect()}
    assert got == fx.PORTS


def test_ports_without_state_check(spark, dict_path):
    e = _entries(spark, dict_path)
    got = {r.port_code: (r.city, r.state_code) for r in lb.ports(e).collect()}
    # without the state list, any trailing two capitals count as a state
    assert got["AG"] == ("AGUA", "MX")
    assert got["UNK"] == ("UNKNOWN", None)


def test_states_and_modes(spark, dict_path):
    e = _entries(spark, dict_path)
    st = {r.state_code: r.state_name for r in lb.states(e).collect()}
    assert st["DC"] == "DOVE COUNTY" and st["AK"] == "ALDER KEEP" and "99" in st
    modes = {r.mode_code: r.mode_name for r in lb.modes(e).collect()}
    assert modes == {1: "Balloon", 2: "Raft", 3: "Mule", 9: "Unknown way"}


def test_parse_survives_small_splits_and_batches(spark, dict_path):
    """Blocks spanning many input splits and Arrow batches parse the same."""
    base = sorted(tuple(r) for r in _entries(spark, dict_path).collect())
    old_split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    old_batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
        lines = read_text_lines(spark, dict_path)
        assert lines.select("block").distinct().count() > 10
        small = sorted(tuple(r) for r in _entries(spark, dict_path).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old_split)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old_batch)
    assert small == base


def test_multi_file_dictionary_in_path_order(spark, tmp_dir):
    """A block may continue into the next file of a directory."""
    text = fx.DICTIONARY.splitlines(keepends=True)
    cut = next(i for i, l in enumerate(text) if "'PRT'" in l)
    with open(f"{tmp_dir}/part-00000.txt", "w") as fh:
        fh.writelines(text[:cut])
    with open(f"{tmp_dir}/part-00001.txt", "w") as fh:
        fh.writelines(text[cut:])
    e = lb.code_labels(spark, tmp_dir)
    got = {r.port_code: (r.city, r.state_code) for r in lb.ports(e, lb.states(e)).collect()}
    assert got == fx.PORTS


def test_no_driver_collect_in_parse_plan(spark, dict_path):
    plan = _entries(spark, dict_path)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan


label_text = st.text(alphabet=st.sampled_from(list("ABCXYZ abc'(),.#-/0189")),
                     min_size=1, max_size=24).filter(lambda s: s.strip() != "")
code_text = st.text(alphabet=st.sampled_from(list("ABZ019.$_")), min_size=1, max_size=5)


def _fmt_entry(code, label, numeric, shape):
    lab = "'" + label.replace("'", "''") + "'"
    c = code if numeric else f"'{code}'"
    return [f"   {c} =  {lab}", f"\t{c}\t=\t{lab}", f"{c}={lab}", f"  {c} = {lab}  "][shape]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(code_text, label_text, st.integers(0, 3)), min_size=1, max_size=12,
                unique_by=lambda t: t[0]),
       st.lists(st.tuples(st.integers(0, 99999), label_text, st.integers(0, 3)), min_size=1,
                max_size=12, unique_by=lambda t: t[0]))
def test_parse_inverts_format(spark, tmp_path_factory, quoted_entries, numeric_entries):
    lines = ["/* generated */", "  value $qfmt"]
    lines += [_fmt_entry(c, lab, False, s) for c, lab, s in quoted_entries]
    lines += [";", "/* between blocks: 7 = 'not an entry' */", "value nfmt"]
    lines += [_fmt_entry(str(c), lab, True, s) for c, lab, s in numeric_entries]
    lines[-1] += " ;"
    p = tmp_path_factory.mktemp("prop") / "d.txt"
    p.write_text("\n".join(lines) + "\n")
    got = sorted((r.fmt, r.code, r.label) for r in lb.code_labels(spark, str(p)).collect())
    want = sorted([("$qfmt", c.strip(), lab.rstrip()) for c, lab, _ in quoted_entries]
                  + [("nfmt", str(c), lab.rstrip()) for c, lab, _ in numeric_entries])
    assert got == want


def test_comment_with_semicolon_inside_block(spark, tmp_path):
    p = tmp_path / "d.txt"
    p.write_text("value $blk\n 'A' = 'ALPHA'\n /* see note; more */\n 'B' = 'BRAVO' /* x; */\n;\n"
                 "/* value $fake */\n 'C' = 'NOT IN A BLOCK'\n")
    got = sorted((r.fmt, r.code, r.label) for r in lb.code_labels(spark, str(p)).collect())
    assert got == [("$blk", "A", "ALPHA"), ("$blk", "B", "BRAVO")]


def test_trailing_comment_with_quote_is_not_label(spark, tmp_path):
    p = tmp_path / "d.txt"
    p.write_text("value $blk\n 'A' = 'ALPHA' /* it's old */\n;\n")
    got = [(r.code, r.label) for r in lb.code_labels(spark, str(p)).collect()]
    assert got == [("A", "ALPHA")]


def test_byte_order_mark_before_first_header(spark, tmp_path):
    p = tmp_path / "bom.txt"
    p.write_bytes("value $blk\n 'A' = 'ALPHA'\n;\n".encode("utf-8-sig"))
    got = [(r.fmt, r.code, r.label) for r in lb.code_labels(spark, str(p)).collect()]
    assert got == [("$blk", "A", "ALPHA")]


def test_comments_over_lines_inside_and_between_blocks(spark, tmp_path):
    p = tmp_path / "d.txt"
    p.write_text("/* opens\n value $no\n 'X' = 'NOT AN ENTRY' */ value $blk\n 'A' = 'ALPHA'\n"
                 " /* 'B' = 'BRAVO'\n closes here; */\n 'C' = 'CHARLIE /* kept */'\n"
                 " /* one */ 'D' = 'DELTA' /* two\n ; */ 'E' = 'ECHO'\n;\n 'F' = 'OUTSIDE'\n")
    want = [("$blk", "A", "ALPHA"), ("$blk", "D", "DELTA"), ("$blk", "E", "ECHO")]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "23"):  # whole, and cut inside comments and lines
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = sorted((r.fmt, r.code, r.label) for r in lb.code_labels(spark, str(p)).collect())
            assert [g for g in got if g[1] != "C"] == want
            assert [g[:2] for g in got if g[1] == "C"] == [("$blk", "C")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_parse_reads_the_text_once(spark, dict_path):
    """Native, and the split summary reuses the lines' one shuffle."""
    key = "spark.sql.adaptive.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        plan = lb.code_labels(spark, dict_path)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, old)
    assert "Pandas" not in plan and "Python" not in plan and "Arrow" not in plan
    assert plan.count("FileScan text") == 1 and "ReusedExchange" in plan


def _read_in_order(lines):
    """(code, open block) of every line by one walk over the text."""
    import re
    inside, block, out = False, None, []
    for line in lines:
        code, at = "", 0
        while at < len(line):
            if inside:
                end = line.find("*/", at)
                if end < 0:
                    break
                at, inside = end + 2, False
                continue
            m = re.compile(r"'(?:[^']|'')*'|/[*]").search(line, at)
            code += line[at:m.start() if m else len(line)]
            if not m:
                break
            at, inside = m.end(), m.group() == "/*"
            code += "" if inside else m.group()
        out.append((code, block))
        header = re.search(r"(?i)^\s*value\s+(\$?\w+)", code)
        if re.search(r";\s*$", code):
            block = None
        elif header:
            block = header.group(1)
    return out


pieces = st.lists(st.sampled_from(["/*", "*/", "/", "*", "'", "''", " ", "a", ";", "value $b", "value c",
                                   "'x'='y'", "'k' = 'l /* m */'", "1='it''s'"]), max_size=5)


@settings(max_examples=10, deadline=None)
@given(st.lists(pieces, min_size=1, max_size=40), st.sampled_from(["128m", "150"]))
def test_every_line_stands_where_a_walk_finds_it(spark, tmp_path_factory, text, size):
    """Comments, quotes and blocks in any disorder, cut into splits anywhere."""
    lines = ["".join(p) for p in text]
    path = tmp_path_factory.mktemp("walk") / "d.txt"
    path.write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        rows = lb.label_lines(read_text_lines(spark, str(path))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    rows.sort(key=lambda r: (r.block, r.row))
    assert [r.value for r in rows] == lines
    assert [(r.code, r.fmt) for r in rows] == _read_in_order(lines)


def test_label_keeps_comment_marks_in_quotes(spark, tmp_path):
    p = tmp_path / "d.txt"
    p.write_text("value $blk\n 'A' = 'ALPHA /* kept */ end'\n;\n")
    assert [r.label for r in lb.code_labels(spark, str(p)).collect()] == ["ALPHA /* kept */ end"]

"""Jobs that begin at files: errors by line number, the first lines, prompts from a folder."""

import json
import uuid
from urllib.parse import unquote

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from extractkit.operators import extract, validate
from extractkit.plans import inputs
from extractkit.schema import DAMAGE_FIELDS
from extractkit.session import fresh_path
from extractkit.sources import jsonl

GOOD = json.dumps(
    {
        "prompt": "p",
        "completion": json.dumps({"damage": dict.fromkeys(DAMAGE_FIELDS, False), "overall_severity": "low"}),
    }
)


def written(tmp_path, files):
    for name, lines in files.items():
        (tmp_path / name).write_text("".join(f"{line}\n" for line in lines))
    return str(tmp_path)


@pytest.mark.parametrize("at_once", [200_000, 1])
def test_errors_have_the_file_and_number_of_their_line(spark, tmp_path, monkeypatch, at_once):
    monkeypatch.setattr(jsonl, "BLOCKS_AT_ONCE", at_once)
    path = written(tmp_path, {"a.jsonl": [GOOD, "", "nope", GOOD, "[]"], "b.jsonl": ["{}", GOOD], "c.jsonl": [GOOD]})
    got = {(r.file[-7:], r.line_no, r.code, r.path) for r in validate.validate_file(spark, path).collect()}
    assert got == {("a.jsonl", 3, "V01", ""), ("a.jsonl", 5, "V02", ""), ("b.jsonl", 1, "V03", "prompt")}
    one = {(r.line_no, r.code) for r in validate.validate_file(spark, path, per_file=False).collect()}
    assert one == {(3, "V01"), (5, "V02"), (6, "V03")}


def test_clean_lines_do_not_meet_the_table_of_blocks(spark, tmp_path):
    path = written(tmp_path, {"a.jsonl": [GOOD] * 50 + ["nope"]})
    found = validate.validate_file(spark, path)
    plan = found._jdf.queryExecution().executedPlan().toString()
    join, faults = plan.index("BroadcastHashJoin"), plan.index("isnotnull(code")
    # read from the top: the filter stands below the join, and nothing is shuffled
    assert join < faults and "hashpartitioning" not in plan and "rangepartitioning" not in plan
    assert [(r.line_no, r.code) for r in found.collect()] == [(51, "V01")]
    assert validate.validate_file(spark, written(tmp_path, {"a.jsonl": []})).count() == 0


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 9, 100])
def test_first_lines_in_the_order_of_files(spark, tmp_path, n):
    files = {"part-99999.txt": ["a", " ", "b", "b"], "part-100000.txt": ["", "c"], "part-9[x].txt": ["first"]}
    files |= {f"part-20000{i}.txt": [f"last {i}", ""] for i in range(6)}
    path = written(tmp_path, files)
    want, at = [], 0
    for name in sorted(files, key=lambda f: int(f.split("-")[1].split(".")[0].split("[")[0])):
        for line in files[name]:
            at += 1
            want += [(at, line)] if line.strip() else []
    got = jsonl.first_lines(spark, path, n, by_part=True).collect()
    assert [tuple(r) for r in got] == want[:n]


def test_first_lines_leave_later_files_unread(spark, tmp_path):
    path = written(tmp_path, {f"f{i:02}.txt": [f"{i}"] * 10 for i in range(40)})
    few = jsonl.first_lines(spark, path, 15)
    # the first file, then the next two
    assert sum(f.endswith(".txt") for f in few.inputFiles()) == 3 and few.count() == 15


def test_prompts_from_a_folder(spark, tmp_path):
    texts = tmp_path / "texts"
    texts.mkdir()
    (tmp_path / "template.txt").write_text("Read:\n{narrative_text}\nEnd {narrative_text}")
    for name, text in {"a.txt": " one\ntwo \n", "b.txt": "\n\t ", "c [1]%.txt": "", "d.txt": "fail", "e.txt": "json"}.items():
        (texts / name).write_text(text)

    def predictor():
        def reply(prompt):
            if "fail" in prompt:
                raise RuntimeError("refused")
            return 'So: {"b": 1, "a": {}} ok' if "json" in prompt else prompt

        return lambda prompts: [reply(p) for p in prompts]

    out = fresh_path(spark, "job")
    answered, rejected = extract.prompt_files(spark, str(tmp_path / "template.txt"), str(texts), predictor, out)
    last = F.substring_index("file", "/", -1).alias("file")
    got = {r.file: (r.output, r.error) for r in answered.select(last, "output", "error").collect()}
    assert got == {
        "a.txt": ("Read:\none\ntwo\nEnd one\ntwo", None),
        "d.txt": ("", "RuntimeError: refused"),
        "e.txt": ('{"a":{},"b":1}', None),
    }
    none = {(r.file, r.reason) for r in rejected.select(last, "reason").collect()}
    assert none == {("b.txt", "empty_narrative"), ("c%20%5B1%5D%25.txt", "empty_narrative")}
    with pytest.raises(ValueError, match="one template"):
        extract.prompt_files(spark, str(texts), str(texts), predictor, out + "x")


def test_a_file_for_each_text_without_sparks_writer(spark, tmp_path):
    rows = [(1, "a"), (2, ""), (None, "é\nx"), (1, "a"), (-7, None), (2, " ")]
    texts = spark.createDataFrame(rows, "id long, value string").coalesce(1)
    texts.write.partitionBy("id").text(str(tmp_path / "spark"))
    inputs.write_apart(texts, str(tmp_path / "apart"))
    wanted, got = (
        sorted((str(r.id), sorted(r.value.split("\n"))) for r in spark.read.text(f"{tmp_path}/{x}", wholetext=True).collect())
        for x in ("spark", "apart")
    )
    assert got == wanted and len(got) == 4
    # Spark's writer leaves a checksum beside each text, set up by processes of its own
    assert not list((tmp_path / "apart").rglob("*.crc")) and not list((tmp_path / "apart").glob("*/.*"))


def test_small_files_are_read_in_few_tasks(spark, tmp_path):
    for i in range(200):
        (tmp_path / f"id={i}").mkdir()
        (tmp_path / f"id={i}" / "t.txt").write_text("" if i % 10 == 0 else f"text {i}")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    read, listed = jsonl.named_files(spark, str(tmp_path))
    with jsonl.many_files(spark):
        assert read.rdd.getNumPartitions() <= 4 and listed.count() == 200
    assert spark.conf.get("spark.sql.files.openCostInBytes") == cost
    answered, rejected = extract.prompt_files(
        spark, str(tmp_path / "id=1"), str(tmp_path), lambda: lambda prompts: prompts, fresh_path(spark, "job")
    )
    assert answered.count() == 180
    assert {r.reason for r in rejected.collect()} == {"empty_narrative"} and rejected.count() == 20


@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("stored", [False, True])
def test_narratives_are_read_in_parts(spark, tmp_path, monkeypatch, stored, keyed):
    """The driver never plans more files than a part has; the same files are read as by Spark from the folder."""
    monkeypatch.setattr(jsonl, "FILES_AT_ONCE", 7)
    # a store that only Spark reads, of another name each time: it is known by it
    spark.conf.set(f"fs.viewfs.mounttable.{(store := uuid.uuid4().hex)}.link./in", f"file://{tmp_path}")
    (tmp_path / "template.txt").write_text("Read: {narrative_text}")
    texts = tmp_path / "te xts"
    unread = ["_temporary/id=9/t.txt", ".x/id=9/t.txt", "_id/t.txt", "id=9/.t.txt.crc"] if keyed else ["_t.txt", ".t.txt"]
    unread += [] if keyed else ["deeper/t.txt", "t.txt._COPYING_"]
    names = [f"id={i}/ü {i}%[{i}].txt" if keyed else f"ü {i}%[{i}].txt" for i in range(23)]
    names += ["id=7/second=2/t.txt", "id=8/plain/t.txt"] if keyed else []
    for n, name in enumerate([*names, *unread]):
        (texts / name).parent.mkdir(parents=True, exist_ok=True)
        (texts / name).write_text("" if n % 10 == 0 else " " if n % 10 == 1 else f"text {name}")
    path = f"viewfs://{store}/in/te xts" if stored else f"{tmp_path}/te xts"
    planned = []
    monkeypatch.setattr(extract, "read_part", lambda s, part: planned.append(len(part)) or jsonl.read_part(s, part))
    answered, rejected = extract.prompt_files(
        spark, str(tmp_path / "template.txt"), path, lambda: lambda prompts: prompts, fresh_path(spark, "job")
    )
    assert planned == [7, 7, 7, len(names) - 21]
    if not keyed:
        read = spark.read.text(path, wholetext=True).select("_metadata.file_path", "value").collect()
        assert {r.file: r.output for r in answered.collect()} == {f: f"Read: {v}" for f, v in read if v.strip()}
    got = {unquote(r.file).rpartition("/te xts/")[2] for r in answered.collect()}
    none = {unquote(r.file).rpartition("/te xts/")[2] for r in rejected.collect()}
    assert got == {n for i, n in enumerate(names) if i % 10 > 1} and none == set(names) - got
    assert answered.count() + rejected.count() == len(names)


def test_no_narratives_and_no_folder(spark, tmp_path):
    (tmp_path / "template.txt").write_text("Read: {narrative_text}")
    (tmp_path / "texts").mkdir()
    asked = [str(tmp_path / "template.txt"), str(tmp_path / "texts"), lambda: lambda prompts: prompts]
    answered, rejected = extract.prompt_files(spark, *asked, fresh_path(spark, "job"))
    assert answered.count() == 0 and rejected.count() == 0
    asked[1] += "/none"
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        extract.prompt_files(spark, *asked, fresh_path(spark, "job"))

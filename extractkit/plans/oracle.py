"""The registered queries as DuckDB SQL, for checking the Spark results.

Written against the tables alone: each statement derives its inputs again from the same md5 draws.
"""

from __future__ import annotations

from extractkit.functions import draws
from extractkit.functions import tokens as K
from extractkit.functions.jsonshape import MOST_DEPTH, MOST_NUMBER
from extractkit.functions.text import WHITESPACE
from extractkit.operators import encode as E
from extractkit.operators import evaluate as A
from extractkit.operators import generate as G
from extractkit.operators import student as ST
from extractkit.operators.phrases import INTROS, PHRASES
from extractkit.operators.prompts import PLACEHOLDER, PROMPT_PREFIX, PROMPT_TEMPLATE
from extractkit.plans import inputs as I
from extractkit.schema import (
    DAMAGE_FIELDS,
    LOW_MAX_FLAGS,
    MODERATE_MAX_FLAGS,
    NARRATIVE_FIELDS,
    REQUIRED_KEYS,
    SEVERITIES,
    SPLITS,
)

DOCUMENTS = "SELECT doc_id AS id FROM documents"
ORDERS = "SELECT o_orderkey AS id FROM orders"
FLAG_LIST = ", ".join(DAMAGE_FIELDS)


def lit(text: str) -> str:
    """A SQL string literal; control and non-ASCII characters as chr()."""
    pieces, plain = [], ""
    for ch in text:
        if " " <= ch <= "~":
            plain += "''" if ch == "'" else ch
        else:
            pieces += [f"'{plain}'"] if plain else []
            plain = ""
            pieces.append(f"chr({ord(ch)})")
    pieces += [f"'{plain}'"] if plain or not pieces else []
    return "(" + " || ".join(pieces) + ")" if len(pieces) > 1 else pieces[0]


def digest(seed: int, stream: str, key: str = "id") -> str:
    return f"md5('{seed}:' || {key} || ':{stream}')"


def word(digest_sql: str, slot: int) -> str:
    return f"substr({digest_sql}, {8 * slot + 1}, 8)"


def number(word_sql: str) -> str:
    return f"('0x' || {word_sql})::BIGINT"


def chance(word_sql: str, p: float) -> str:
    return f"({word_sql} < '{draws.word_threshold(p)}')"


def stripped(text: str, chars: str = WHITESPACE) -> str:
    return f"trim({text}, {lit(chars)})"


def with_(*ctes: str, query: str) -> str:
    return "WITH " + ",\n".join(c for c in ctes if c) + "\n" + query


# --- generated pairs ----------------------------------------------------------------------------


def _flag_word(i: int) -> str:
    return word(digest(G.SEED, f"flag{i // 4}"), i % 4)


def _pick_word(i: int) -> str:
    return word(digest(G.SEED, f"pick{i // 4}"), i % 4)


def severity_case(count: str) -> str:
    low, moderate, high = SEVERITIES
    return (
        f"CASE WHEN {count} <= {LOW_MAX_FLAGS} THEN '{low}' "
        f"WHEN {count} <= {MODERATE_MAX_FLAGS} THEN '{moderate}' ELSE '{high}' END"
    )


def true_sum() -> str:
    return "(" + " + ".join(f"{f}::BIGINT" for f in DAMAGE_FIELDS) + ")"


def flags_ctes(source: str) -> str:
    drawn = ", ".join(f"{chance(_flag_word(i), r.p)} AS {r.field}" for i, r in enumerate(G.RATES))
    joint = ", ".join(f"({r.given} AND {r.field}) AS {r.field}" if r.given else r.field for r in G.RATES)
    return f"""ids AS ({source}),
drawn AS (SELECT id, {drawn} FROM ids),
joint AS (SELECT id, {joint} FROM drawn),
flags AS (SELECT id, {FLAG_LIST}, {severity_case(true_sum())} AS severity FROM joint)"""


def record_text(severity: str = "severity") -> str:
    parts = " || ',' || ".join(
        f"'\"{f}\":' || CASE WHEN {f} THEN 'true' ELSE 'false' END" for f in DAMAGE_FIELDS
    )
    return f"""('{{"damage":{{' || {parts} || '}},"overall_severity":"' || {severity} || '"}}')"""


def option(options: list[str], i: int) -> str:
    listed = ", ".join(lit(o) for o in options)
    return f"([{listed}])[1 + {number(_pick_word(i))} % {len(options)}]"


def pairs_ctes(source: str) -> str:
    sentences = " || ' ' || ".join(
        f"CASE WHEN {f} THEN {option(PHRASES[f][True], i)} ELSE {option(PHRASES[f][False], i)} END"
        for i, f in enumerate(NARRATIVE_FIELDS)
    )
    intro = option(INTROS, len(NARRATIVE_FIELDS))
    return f"""{flags_ctes(source)},
told AS (SELECT *, {intro} || {sentences} AS narrative FROM flags),
pairs AS (SELECT *, {lit(PROMPT_PREFIX)} || narrative AS prompt, {record_text()} AS completion FROM told)"""


# --- derived inputs -----------------------------------------------------------------------------


def fixture_word(stream: str, slot: int = 0) -> str:
    return word(digest(I.FIXTURE_SEED, stream), slot)


def js(text: str) -> str:
    return f"to_json({text})::VARCHAR"


def pair_line(prompt: str, completion: str) -> str:
    return f"""('{{"prompt":' || {js(prompt)} || ',"completion":' || {js(completion)} || '}}')"""


def bad_lines_cte() -> str:
    line = pair_line("prompt", "completion")
    severity_text = """(',"overall_severity":"' || severity || '"')"""
    broken = "completion"
    for old, new in (
        ('"mould":true,', ""),
        ('"mould":false,', ""),
        ('"odor_present":true', '"odor_present":"true"'),
        ('"odor_present":false', '"odor_present":0'),
    ):
        broken = f"replace({broken}, '{old}', '{new}')"
    damaged = [
        f"' ' || {line} || chr(9)",
        "'  ' || chr(9)",
        f"substr({line}, 1, length({line}) - 1)",
        f"'[' || {line} || ']'",
        f"""'{{"completion":' || {js('completion')} || '}}'""",
        f"""'{{"prompt":' || {js('prompt')} || '}}'""",
        f"""'{{"prompt":17,"completion":' || {js('completion')} || '}}'""",
        f"""'{{"prompt":' || {js('prompt')} || ',"completion":null}}'""",
        pair_line("' '", "completion"),
        pair_line("prompt", "'  '"),
        pair_line("prompt", "substr(completion, 2)"),
        pair_line("prompt", "'[' || completion || ']'"),
        pair_line("prompt", """'{"overall_severity":"low"}'"""),
        pair_line("prompt", """'{"damage":[],"overall_severity":null}'"""),
        pair_line("prompt", broken),
        pair_line(
            "prompt",
            f"CASE WHEN id % 2 = 0 THEN replace(completion, {severity_text}, '') "
            f"""ELSE replace(completion, {severity_text}, ',"overall_severity":"severe"') END""",
        ),
    ]
    branches = " ".join(f"WHEN {i} THEN {d}" for i, d in enumerate(damaged))
    defect = f"{number(fixture_word('defect'))} % {I.DEFECTS}"
    return f"lines AS (SELECT id, CASE {defect} {branches} END AS raw FROM pairs)"


def spaced_lines_cte() -> str:
    line = pair_line("prompt", "completion")
    form = f"{number(fixture_word('space'))} % 8"
    return (
        f"lines AS (SELECT id, CASE {form} WHEN 0 THEN ' ' || chr(9) || ' ' WHEN 1 THEN '  ' || {line} || ' ' "
        f"ELSE {line} END AS raw FROM pairs)"
    )


def gold_cte() -> str:
    w = fixture_word("gold")
    branches = " ".join(f"WHEN {chance(w, bound)} THEN '{text}'" for text, bound in I.GOLD_FORMS)
    return f"gold AS (SELECT id, CASE {branches} ELSE completion END AS completion FROM pairs)"


def outputs_cte(model: str, name: str) -> str:
    def w(i: int) -> str:
        return word(digest(I.FIXTURE_SEED, f"{model}{i // 4}"), i % 4)

    flipped = ", ".join(f"({f} <> {chance(w(i), I.FLIP_RATE)}) AS {f}" for i, f in enumerate(DAMAGE_FIELDS))
    low, moderate, high = SEVERITIES
    turned = (
        f"CASE WHEN {chance(w(10), I.SEVERITY_RATE)} THEN CASE severity WHEN '{low}' THEN '{moderate}' "
        f"WHEN '{moderate}' THEN '{high}' ELSE '{low}' END ELSE severity END AS severity"
    )
    forms = {
        "cut": "'Answer: ' || substr(body, 1, length(body) - 1)",
        "prose": "'I can not tell.'",
        "key_missing": """'Answer: ' || replace(replace(body, '"mould":true,', ''), '"mould":false,', '') || ' done.'""",
        "two_blocks": "'Answer: ' || body || ' or {maybe} done.'",
        "null_severity": """'Answer: ' || replace(body, '"' || severity || '"}', 'null}')""",
        "empty_object": "'Answer: {} done.'",
        "no_row": "NULL",
        "extra_keys": f"substr(body, 1, length(body) - 1) || {lit(I.EXTRA_KEYS)}",
    }
    branches = " ".join(
        f"WHEN form < '{draws.word_threshold(bound)}' THEN {forms[form]}" for form, bound in I.OUTPUT_FORMS
    )
    return f"""{name}_flags AS (SELECT id, {w(11)} AS form, {flipped}, {turned} FROM pairs),
{name}_body AS (SELECT id, form, severity, {record_text()} AS body FROM {name}_flags),
{name}_all AS (SELECT id, CASE {branches} ELSE 'Answer: ' || body || ' done.' END AS raw_output FROM {name}_body),
{name} AS (SELECT * FROM {name}_all WHERE raw_output IS NOT NULL)"""


def greedy(text: str) -> str:
    return rf"regexp_extract({text}, '\{{.*\}}', 0, 's')"


def balanced_ctes(source: str, name: str) -> str:
    """name(id, block): running brace depth over single characters."""
    return f"""{name}_tail AS (SELECT id, CASE WHEN strpos(raw_output, '{{') > 0
    THEN substr(raw_output, strpos(raw_output, '{{')) ELSE '' END AS tail FROM {source}),
{name}_chars AS (SELECT id, tail, unnest(generate_series(1, length(tail))) AS place FROM {name}_tail),
{name}_depth AS (SELECT id, place, sum(CASE substr(tail, place, 1) WHEN '{{' THEN 1 WHEN '}}' THEN -1 ELSE 0 END)
    OVER (PARTITION BY id ORDER BY place) AS depth FROM {name}_chars),
{name}_end AS (SELECT id, min(place) AS last FROM {name}_depth WHERE depth = 0 GROUP BY id),
{name} AS (SELECT t.id, CASE WHEN e.last IS NULL THEN '' ELSE substr(t.tail, 1, e.last) END AS block
    FROM {name}_tail t LEFT JOIN {name}_end e ON t.id = e.id)"""


def flat_ctes(source: str, name: str, text: str) -> str:
    """name(id, path, value, type) from JSON objects; other texts give no rows."""
    kinds = (
        "CASE type WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' "
        "WHEN 'ARRAY' THEN 'array' ELSE 'number' END"
    )
    return f"""{name}_ok AS (SELECT id, {text} AS txt FROM {source} WHERE json_valid({text})),
{name} AS (SELECT o.id, substr(j.fullkey, 3) AS path, coalesce(j.value::VARCHAR, 'null') AS value, {kinds} AS type
    FROM {name}_ok o, json_tree(o.txt) j
    WHERE j.type <> 'OBJECT' AND j.fullkey <> '$' AND strpos(j.fullkey, '[') = 0)"""


def rendered_object(text: str) -> str:
    """A model output object as compact text with keys sorted."""

    def entry(name: str, path: str) -> str:
        return (
            f"CASE WHEN json_type({text}, '{path}') IS NOT NULL "
            f"THEN '\"{name}\":' || json_extract({text}, '{path}')::VARCHAR END"
        )

    def entries(listed: list[str]) -> str:
        return f"array_to_string(list_filter([{', '.join(listed)}], lambda e: e IS NOT NULL), ',')"

    damage = entries([entry(f, f"$.damage.{f}") for f in sorted(DAMAGE_FIELDS)])
    notes = '"notes":{"by":"m","deep":{"e":null,"er":1},"none":{},"tags":["x",1]}'
    top = entries(
        [
            f"CASE WHEN json_type({text}, '$.damage') IS NOT NULL THEN '\"damage\":{{' || {damage} || '}}' END",
            f"CASE WHEN json_type({text}, '$.notes') IS NOT NULL THEN '{notes}' END",
            entry("overall_severity", "$.overall_severity"),
        ]
    )
    return f"'{{' || coalesce({top}, '') || '}}'"


def two_flat() -> str:
    return ",\n".join(
        [
            pairs_ctes(DOCUMENTS),
            outputs_cte("a", "oa"),
            outputs_cte("b", "ob"),
            balanced_ctes("oa", "ba"),
            balanced_ctes("ob", "bb"),
            flat_ctes("ba", "fa", "block"),
            flat_ctes("bb", "fb", "block"),
        ]
    )


COMPARED = """compared AS (SELECT coalesce(a.id, b.id) AS id, coalesce(a.path, b.path) AS path,
    coalesce(a.value, '<missing>') AS value_a, coalesce(b.value, '<missing>') AS value_b,
    nullif(a.value, 'null') IS NOT DISTINCT FROM nullif(b.value, 'null') AS is_match
    FROM fa a FULL OUTER JOIN fb b ON a.id = b.id AND a.path = b.path
    WHERE coalesce(a.id, b.id) IN (SELECT x.id FROM fa_ok x JOIN fb_ok y ON x.id = y.id))"""

MODELS = """per_id AS (SELECT id, count(*) AS keys, sum(is_match::BIGINT)::BIGINT AS matches FROM compared GROUP BY id),
sides AS (SELECT coalesce(a.id, b.id) AS id, coalesce(json_valid(a.block), false) AS ok_a,
    coalesce(json_valid(b.block), false) AS ok_b FROM ba a FULL OUTER JOIN bb b ON a.id = b.id),
models AS (SELECT s.id, CASE WHEN NOT ok_a THEN 'no_json_a' WHEN NOT ok_b THEN 'no_json_b' END AS rejected,
    CASE WHEN ok_a AND ok_b THEN coalesce(p.keys, 0) END AS keys,
    CASE WHEN ok_a AND ok_b THEN coalesce(p.matches, 0) END AS matches
    FROM sides s LEFT JOIN per_id p ON s.id = p.id)"""


# --- splits -------------------------------------------------------------------------------------


def split_ctes(source: str, train: float, valid: float, seed: int = 42) -> str:
    return f"""ranked AS (SELECT *, row_number() OVER (ORDER BY md5('{seed}:' || id), id) AS rank,
    count(*) OVER () AS total FROM ({source}) s),
cuts AS (SELECT *, floor(total::DOUBLE * {train})::BIGINT AS first,
    floor(total::DOUBLE * {train})::BIGINT + floor(total::DOUBLE * {valid})::BIGINT AS second FROM ranked),
split AS (SELECT *, CASE WHEN rank <= first THEN '{SPLITS[0]}' WHEN rank <= second THEN '{SPLITS[1]}'
    ELSE '{SPLITS[2]}' END AS split, CASE WHEN rank <= first THEN rank WHEN rank <= second THEN rank - first
    ELSE rank - second END AS pos FROM cuts)"""


ORDER_SPLIT = split_ctes(ORDERS, 0.8, 0.1)


# --- validation ---------------------------------------------------------------------------------


def validation_ctes(source: str) -> str:
    """checked(id, errors, non_blank); errors is a list of 'code:path'."""
    fields = []
    for f in DAMAGE_FIELDS:
        path = f"completion.damage.{f}"
        at = f"json_type(rec, '$.damage.{f}')"
        fields.append(f"CASE WHEN {at} IS NULL THEN 'V10:{path}' WHEN {at} <> 'BOOLEAN' THEN 'V11:{path}' END")
    damage = (
        "CASE WHEN json_type(rec, '$.damage') IS NULL THEN ['V08:completion.damage'] "
        "WHEN json_type(rec, '$.damage') <> 'OBJECT' THEN ['V09:completion.damage'] "
        f"ELSE [{', '.join(fields)}] END"
    )
    allowed = ", ".join(f"'\"{s}\"'" for s in SEVERITIES)
    severity = (
        "[CASE WHEN json_type(rec, '$.overall_severity') IS NULL THEN 'V12:completion.overall_severity' "
        f"WHEN json_extract(rec, '$.overall_severity')::VARCHAR NOT IN ({allowed}) "
        "THEN 'V13:completion.overall_severity' END]"
    )

    def text_rules(key: str) -> str:
        return (
            f"CASE WHEN {key}_type <> 'VARCHAR' THEN 'V04:{key}' "
            f"WHEN {stripped(key + '_text')} = '' THEN 'V05:{key}' END"
        )

    prompt, completion = text_rules("prompt"), text_rules("completion")
    return f"""{source},
stripped AS (SELECT id, {stripped('raw')} AS line FROM lines),
roots AS (SELECT id, line, json_valid(line) AS ok, CASE WHEN json_valid(line) THEN line ELSE 'null' END AS js
    FROM stripped),
members AS (SELECT *, json_type(js) AS root_type, json_type(js, '$.prompt') AS prompt_type,
    json_type(js, '$.completion') AS completion_type, json_extract_string(js, '$.prompt') AS prompt_text,
    json_extract_string(js, '$.completion') AS completion_text FROM roots),
records AS (SELECT *, completion_type = 'VARCHAR' AS has_text, CASE WHEN completion_type = 'VARCHAR'
    AND json_valid(completion_text) THEN completion_text END AS rec_text FROM members),
typed AS (SELECT *, coalesce(rec_text, '{{}}') AS rec FROM records),
found AS (SELECT id, line, CASE
    WHEN line = '' THEN []::VARCHAR[]
    WHEN NOT ok THEN ['V01:']
    WHEN root_type <> 'OBJECT' THEN ['V02:']
    WHEN prompt_type IS NULL THEN ['V03:prompt']
    WHEN completion_type IS NULL THEN [{prompt}, 'V03:completion']
    WHEN NOT has_text THEN [{prompt}, {completion}]
    WHEN rec_text IS NULL THEN [{prompt}, {completion}, 'V06:completion']
    WHEN json_type(rec) <> 'OBJECT' THEN [{prompt}, {completion}, 'V07:completion']
    ELSE list_concat([{prompt}, {completion}], list_concat({damage}, {severity})) END AS listed FROM typed),
checked AS (SELECT id, list_filter(listed, lambda e: e IS NOT NULL) AS errors, line <> '' AS non_blank FROM found)"""


# --- evaluation ---------------------------------------------------------------------------------


def eval_ctes() -> str:
    outputs = [(f, f"$.damage.{f}") for f in DAMAGE_FIELDS] + [("overall_severity", "$.overall_severity")]

    def value(column: str, path: str) -> str:
        return f"nullif(json_extract({column}, '{path}')::VARCHAR, 'null')"

    same = ", ".join(
        f"(valid AND {value('pj', path)} IS NOT DISTINCT FROM {value('gj', path)}) AS m_{name}"
        for name, path in outputs
    )
    sums = ", ".join(f"coalesce(sum(m_{name}::BIGINT), 0)::BIGINT AS m_{name}" for name, _ in outputs)
    lines = ["SELECT 'validity' AS metric, 'json' AS field, n_valid AS correct, total AS denom FROM totals"]
    for name, path in outputs:
        metric = "field_accuracy" if path.startswith("$.damage") else "severity_accuracy"
        lines.append(f"SELECT '{metric}', '{name}', m_{name}, n_valid FROM totals")
    union = " UNION ALL ".join(lines)

    def usable(column: str) -> str:
        return (
            f"CASE WHEN json_valid({column}) THEN json_type({column}) = 'OBJECT' AND {column} <> '{{}}' ELSE false END"
        )

    return f"""{pairs_ctes(DOCUMENTS)},
{gold_cte()},
{outputs_cte("a", "oa")},
blocks AS (SELECT id, {greedy('raw_output')} AS block FROM oa),
paired AS (SELECT g.id, {usable('g.completion')} AS gold_ok, coalesce({usable('b.block')}, false) AS pred_ok,
    g.completion, b.block FROM gold g LEFT JOIN blocks b ON g.id = b.id),
parsed AS (SELECT *, gold_ok AND pred_ok AS valid, CASE WHEN gold_ok THEN completion ELSE '{{}}' END AS gj,
    CASE WHEN pred_ok THEN block ELSE '{{}}' END AS pj FROM paired),
scored AS (SELECT valid, {same} FROM parsed),
totals AS (SELECT count(*) AS total, coalesce(sum(valid::BIGINT), 0)::BIGINT AS n_valid, {sums} FROM scored),
lines AS ({union}),
report AS (SELECT metric, field, correct, denom, CASE WHEN denom > 0 THEN 100.0::DOUBLE * correct / denom
    WHEN metric <> 'validity' THEN 0.0::DOUBLE END AS pct FROM lines)"""


def student_ctes() -> str:
    """predicted(id, flags, severity): the closed form of naive Bayes, class by class as rows."""
    classes = [*DAMAGE_FIELDS, *(f"severity_{x}" for x in SEVERITIES)]
    truth = ", ".join([f"{f} AS {f}" for f in DAMAGE_FIELDS] + [f"severity = '{x}' AS severity_{x}" for x in SEVERITIES])
    as_rows = " UNION ALL ".join(f"SELECT id, split, '{c}' AS class, {c} AS holds FROM marked" for c in classes)

    def log(share: str) -> str:
        return f"round(ln({share}) * {ST.SCALE})::BIGINT"

    share = "((n + 1)::DOUBLE / (n_class + 2)::DOUBLE)"
    flag = f"class IN ({', '.join(map(lit, DAMAGE_FIELDS))})"
    flags = ", ".join(f"bool_or(class = '{f}' AND score > 0) AS {f}" for f in DAMAGE_FIELDS)
    order = "CASE class " + " ".join(f"WHEN 'severity_{x}' THEN {i}" for i, x in enumerate(SEVERITIES)) + " END"
    return f"""{pairs_ctes(DOCUMENTS)},
{split_ctes("SELECT * FROM pairs", 0.8, 0.1)},
marked AS (SELECT id, split, {truth} FROM split),
truth AS ({as_rows}),
worded AS (SELECT id, split, regexp_extract_all(lower(prompt), '{ST.WORD}') AS w FROM split),
bigrams AS (SELECT id, split, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS p FROM worded),
had AS (SELECT DISTINCT id, split, ('0x' || substr(md5(p), 1, 7))::BIGINT % {ST.WIDTH} AS bucket FROM bigrams),
class_sizes AS (SELECT class, holds, count(*) AS n_class FROM truth WHERE split = 'train' GROUP BY class, holds),
sides AS (SELECT class, side.holds, coalesce(n_class, 0) AS n_class FROM (SELECT DISTINCT class FROM truth) c
    CROSS JOIN (VALUES (true), (false)) side(holds) LEFT JOIN class_sizes USING (class, holds)),
seen AS (SELECT bucket, class, holds, count(*) AS n FROM had JOIN truth USING (id, split)
    WHERE split = 'train' GROUP BY bucket, class, holds),
cells AS (SELECT r.bucket, s.class, s.holds, s.n_class, coalesce(n, 0) AS n
    FROM (SELECT unnest(range({ST.WIDTH})) AS bucket) r CROSS JOIN sides s LEFT JOIN seen USING (bucket, class, holds)
    WHERE s.holds OR {flag.replace('class', 's.class', 1)}),
weights AS (SELECT bucket, class, CASE WHEN holds THEN 1 ELSE -1 END AS sign,
    {log(share)} - {log(f"(1 - {share})")} AS w, {log(f"(1 - {share})")} AS base FROM cells),
n_train AS (SELECT count(*) AS n FROM split WHERE split = 'train'),
priors AS (SELECT class, CASE WHEN holds THEN 1 ELSE -1 END *
    {log(f"(n_class + 1)::DOUBLE / (n + CASE WHEN {flag} THEN 2 ELSE {len(SEVERITIES)} END)")} AS prior
    FROM sides, n_train WHERE holds OR {flag}),
always AS (SELECT class, sum(x)::BIGINT AS x FROM (SELECT class, prior AS x FROM priors
    UNION ALL SELECT class, sign * base FROM weights) u GROUP BY class),
asked AS (SELECT id FROM split WHERE split = 'test'),
summed AS (SELECT h.id, w.class, sum(w.sign * w.w)::BIGINT AS x FROM had h JOIN weights w USING (bucket)
    WHERE h.split = 'test' GROUP BY h.id, w.class),
scored AS (SELECT a.id, c.class, c.x + coalesce(s.x, 0) AS score
    FROM asked a CROSS JOIN always c LEFT JOIN summed s ON s.id = a.id AND s.class = c.class),
chosen AS (SELECT id, {flags} FROM scored GROUP BY id),
ranked_severity AS (SELECT id, substr(class, 10) AS severity,
    row_number() OVER (PARTITION BY id ORDER BY score DESC, {order}) AS place FROM scored WHERE class LIKE 'severity!_%' ESCAPE '!'),
predicted AS (SELECT c.*, r.severity FROM chosen c JOIN ranked_severity r ON c.id = r.id AND r.place = 1)"""


def student_report() -> str:
    """One line per output: predictions are always valid records, as gold is."""
    lines = ["SELECT 'validity' AS metric, 'json' AS field, count(*) AS correct, count(*) AS denom FROM compared_"]
    for f in DAMAGE_FIELDS:
        lines.append(f"SELECT 'field_accuracy', '{f}', count(*) FILTER (p.{f} = g.{f}), count(*) FROM compared_")
    lines.append("SELECT 'severity_accuracy', 'overall_severity', count(*) FILTER (p.severity = g.severity), count(*) FROM compared_")
    union = " UNION ALL ".join(x.replace("compared_", "predicted p JOIN pairs g ON p.id = g.id") for x in lines)
    return f"SELECT *, CASE WHEN denom > 0 THEN 100.0::DOUBLE * correct / denom END AS pct FROM ({union}) l"


UNUSABLE = """reasons AS (
    SELECT 'gold' AS side, CASE WHEN gold_ok THEN NULL WHEN json_valid(completion) THEN 'no_object' ELSE 'not_json' END
        AS reason FROM paired
    UNION ALL
    SELECT 'pred', CASE WHEN pred_ok THEN NULL WHEN id NOT IN (SELECT id FROM oa) THEN 'no_row'
        WHEN json_valid(block) THEN 'no_object' ELSE 'not_json' END FROM paired)"""


def sized_ctes() -> str:
    """sized(id, status): depth and digits are measured on the text, not taken from its form."""
    value = js("coalesce(text, '')")
    opened, closed = f"repeat('[', {I.DEEP})", f"repeat(']', {I.DEEP - 1})"
    whole = "'{\"text\":' || value || '}'"
    return f"""values_ AS (SELECT doc_id AS id, doc_id % {I.SIZED_FORMS} AS form, {value} AS value FROM documents),
records AS (SELECT id, CASE form WHEN 0 THEN {whole} WHEN 1 THEN substr({whole}, 1, length({whole}) - 1)
    WHEN 2 THEN {opened} || value || {closed} || ']' WHEN 3 THEN {opened} || value || {closed} || '}}'
    ELSE '{{"n":1' || repeat('0', {I.DIGITS}) || ',"text":' || value || '}}' END AS record FROM values_),
sized AS (SELECT id, CASE WHEN NOT json_valid(record) THEN 'not_json'
    WHEN length(record) - length(ltrim(record, '[')) > {MOST_DEPTH}
      OR length(regexp_extract(record, '^\\{{"n":([0-9]+)', 1)) > {MOST_NUMBER} THEN 'past_limits'
    ELSE 'json' END AS status FROM records)"""


# --- encoding -----------------------------------------------------------------------------------


def encoding_ctes() -> str:
    n = E.MAX_LENGTH
    ident = f"('0x' || substr(md5(t), 1, 7))::BIGINT + {K.FIRST_TOKEN_ID}"
    return rf"""{flags_ctes(DOCUMENTS)},
texts AS (SELECT f.id, {lit(PROMPT_PREFIX)} || d.text AS prompt, {record_text()} AS completion
    FROM documents d JOIN flags f ON d.doc_id = f.id),
toks AS (SELECT id, regexp_extract_all(prompt, '(\w+|[^\w\s])', 1) AS p,
    regexp_extract_all(prompt || completion, '(\w+|[^\w\s])', 1) AS t FROM texts),
encoded AS (SELECT id, least(len(p), {n})::BIGINT AS prompt_len,
    list_transform(t[1:{n}], lambda t: {ident}) AS ids FROM toks),
padded AS (SELECT id, prompt_len, list_concat(ids, list_resize([]::BIGINT[], {n} - len(ids), {K.EOS_ID})) AS input_ids,
    list_concat(list_resize([]::BIGINT[], len(ids), 1), list_resize([]::BIGINT[], {n} - len(ids), 0)) AS attention_mask
    FROM encoded),
labelled AS (SELECT *, list_transform(input_ids, lambda x, i: CASE WHEN i <= prompt_len OR x = {K.EOS_ID}
    THEN {K.IGNORED_LABEL} ELSE x END) AS labels FROM padded)"""


def joined(column: str) -> str:
    return f"coalesce(array_to_string({column}, ' '), '')"


# --- statements ---------------------------------------------------------------------------------


def _build() -> dict[str, str]:
    doc_pairs, order_pairs = pairs_ctes(DOCUMENTS), pairs_ctes(ORDERS)

    def one(i: int) -> str:
        return word(digest(G.SEED, f"one{i // 4}"), i % 4)

    picked = ", ".join(
        f"([{', '.join(map(lit, PHRASES[field][flag]))}])"
        f"[1 + {number(one(i))} % {len(PHRASES[field][flag])}] AS {field}_{'stated' if flag else 'denied'}"
        for i, (field, flag) in enumerate((f, b) for f in DAMAGE_FIELDS for b in (True, False))
    )
    checked = validation_ctes(f"{order_pairs},\n{bad_lines_cte()}")
    outputs_a = f"{doc_pairs},\n{outputs_cte('a', 'oa')}"
    metric = "SELECT field, correct, denom, pct FROM report WHERE metric = '{}'".format
    blank = f"CASE WHEN {number(fixture_word('blank'))} % 8 = 0 THEN chr(9) || ' ' || chr(10) ELSE text END"
    call = f"{number(fixture_word('call'))} % 32"

    def rendered(text: str) -> str:
        return f"replace({lit(PROMPT_TEMPLATE)}, {lit(PLACEHOLDER)}, {text})"

    def phrase_rows() -> str:
        rows = [
            f"({order}, '{field}', {flag}, {idx}, {len(PHRASES[field][flag])}, {lit(p)})"
            for order, field in enumerate(NARRATIVE_FIELDS)
            for flag in (True, False)
            for idx, p in enumerate(PHRASES[field][flag])
        ]
        return f"phrases(ord, field, flag, idx, n, phrase) AS (VALUES {', '.join(rows)})"

    picks = " UNION ALL ".join(
        f"SELECT id, '{f}' AS field, {f} AS flag, {number(_pick_word(i))} AS num FROM flags"
        for i, f in enumerate(NARRATIVE_FIELDS)
    )
    mentioned = ", ".join(
        "(" + " OR ".join(f"contains({{text}}, {lit(p)})" for p in PHRASES[f][True]) + f") AS {f}" for f in DAMAGE_FIELDS
    )
    answer = (
        """'Answer: {"damage":{' || """
        + " || ',' || ".join(f"'\"{f}\":' || CASE WHEN {f} THEN 'true' ELSE 'false' END" for f in DAMAGE_FIELDS)
        + " || '}} done.'"
    )
    absent = ", ".join(f"CASE WHEN json_type(js, '$.{k}') IS NULL THEN '{k}' END" for k in REQUIRED_KEYS)

    sql = {
        "bernoulli_flags": "SELECT id, "
        + ", ".join(f"{chance(one(i), r.p)} AS {r.field}" for i, r in enumerate(G.RATES))
        + f" FROM ({ORDERS}) o",
        "pick_phrase": f"SELECT id, {picked} FROM ({ORDERS}) o",
        "damage_flags": with_(flags_ctes(ORDERS), query="SELECT * FROM flags"),
        "true_counts": with_(flags_ctes(ORDERS), query=f"SELECT id, {true_sum()} AS n_true FROM flags"),
        "severity_buckets": with_(
            flags_ctes(ORDERS),
            query=f"SELECT severity, {true_sum()} AS n_true, count(*) AS n_rows FROM flags GROUP BY 1, 2",
        ),
        "serialize_completion": with_(flags_ctes(ORDERS), query=f"SELECT id, {record_text()} AS completion FROM flags"),
        "narrative_lookup": with_(
            flags_ctes(DOCUMENTS),
            phrase_rows(),
            f"picks AS ({picks})",
            query="SELECT k.id, p.ord::BIGINT AS ord, k.field, k.flag, p.idx::BIGINT AS idx, p.phrase FROM picks k "
            "JOIN phrases p ON k.field = p.field AND k.flag = p.flag AND k.num % p.n = p.idx",
        ),
        "build_narrative": with_(doc_pairs, query="SELECT id, narrative FROM pairs"),
        "prefix_prompt": f"SELECT doc_id AS id, {lit(PROMPT_PREFIX)} || text AS prompt FROM documents",
        "generate_pairs": with_(
            order_pairs, query=f"SELECT id, {FLAG_LIST}, severity, narrative, prompt, completion FROM pairs"
        ),
        "render_prompt": f"SELECT doc_id AS id, {rendered('text')} AS prompt FROM documents",
        "strip_padded_text": f"""SELECT id, turn, {stripped('text')} AS stripped FROM (
            SELECT doc_id AS id, 0::BIGINT AS turn, text FROM documents
            UNION ALL SELECT conv_id, turn, text FROM conversations) t""",
        "reject_empty": f"""WITH n AS (SELECT doc_id AS id, text FROM documents),
            b AS (SELECT id, {stripped(blank)} AS s FROM n)
            SELECT id, CASE WHEN s = '' THEN 'empty_narrative' END AS reason,
            CASE WHEN s <> '' THEN {rendered('s')} END AS prompt FROM b""",
        "json_blocks_greedy": with_(outputs_a, query=f"SELECT id, {greedy('raw_output')} AS block FROM oa"),
        "json_blocks_balanced": with_(outputs_a, balanced_ctes("oa", "ba"), query="SELECT id, block FROM ba"),
        "safe_parse": with_(
            outputs_a,
            f"b AS (SELECT id, {greedy('raw_output')} AS block FROM oa)",
            query="SELECT id, json_valid(block) AS ok, CASE WHEN json_valid(block) "
            "THEN json_extract_string(block, '$.overall_severity') END AS severity FROM b",
        ),
        "render_output": with_(
            outputs_a,
            balanced_ctes("oa", "ba"),
            "raws AS (SELECT o.id, o.raw_output, b.block, CASE WHEN json_valid(b.block) THEN b.block END AS obj "
            "FROM oa o JOIN ba b ON o.id = b.id)",
            query=f"SELECT id, CASE WHEN obj IS NOT NULL THEN {rendered_object('obj')} "
            "WHEN block <> '' THEN block ELSE raw_output END AS output FROM raws",
        ),
        "json_flatten": f"""WITH recs AS (SELECT event_id AS id, '{{"id":' || event_id || ',"kind":'
            || {js('event_type')} || ',"props":' || props || ',"none":{{}},"list":[1,{{"x":2}}],"nil":null,"user":{{"ids":{{"main":'
            || user_id || ',"other":{{}}}}}}}}' AS record FROM events),
            {flat_ctes("recs", "flat", "record")} SELECT id, path, value, type FROM flat""",
        "missing_keys": with_(
            doc_pairs,
            bad_lines_cte(),
            f"s AS (SELECT id, {stripped('raw')} AS line FROM lines)",
            "v AS (SELECT id, CASE WHEN json_valid(line) THEN line ELSE '[]' END AS js FROM s)",
            query="SELECT id, CASE WHEN json_type(js) = 'OBJECT' THEN coalesce(array_to_string("
            f"list_filter([{absent}], lambda k: k IS NOT NULL), '|'), '') END AS missing FROM v",
        ),
        "load_jsonl": with_(
            doc_pairs,
            spaced_lines_cte(),
            query=f"SELECT json_extract_string({stripped('raw')}, '$.prompt') AS prompt, "
            f"json_extract_string({stripped('raw')}, '$.completion') AS completion "
            f"FROM lines WHERE {stripped('raw')} <> ''",
        ),
        "numbered_scan": with_(
            doc_pairs,
            bad_lines_cte(),
            query=f"SELECT row_number() OVER (ORDER BY id) AS line_no, raw, {stripped('raw')} <> '' AS non_blank FROM lines",
        ),
        "first_lines": with_(
            doc_pairs,
            spaced_lines_cte(),
            "numbered AS (SELECT row_number() OVER (ORDER BY id) AS line_no, raw FROM lines)",
            query=f"SELECT line_no, raw FROM numbered WHERE {stripped('raw')} <> '' "
            f"ORDER BY line_no LIMIT {A.MAX_EXAMPLES}",
        ),
        "validate_file": with_(
            checked,
            "numbered AS (SELECT row_number() OVER (ORDER BY id) AS line_no, errors FROM checked)",
            query="SELECT line_no, split_part(e, ':', 1) AS code, split_part(e, ':', 2) AS path "
            "FROM (SELECT line_no, unnest(errors) AS e FROM numbered) u",
        ),
        "prompt_files": with_(
            doc_pairs,
            f"notes AS (SELECT id, {number(fixture_word('blank'))} % 8 = 0 AS none, narrative FROM pairs)",
            f"read AS (SELECT id, none, {mentioned.replace('{text}', 'narrative')} FROM notes)",
            f"replies AS (SELECT id, none, {answer} AS reply FROM read)",
            "raws AS (SELECT id, none, substr(reply, 9, length(reply) - 14) AS obj FROM replies)",
            query="SELECT id, CASE WHEN none THEN 'empty_narrative' END AS reason, "
            f"CASE WHEN NOT none THEN {rendered_object('obj')} END AS output FROM raws",
        ),
        "jsonl_roundtrip": with_(doc_pairs, query="SELECT prompt, completion FROM pairs"),
        "split_files": with_(
            doc_pairs,
            split_ctes("SELECT id, prompt, completion FROM pairs", 0.8, 0.1),
            query="SELECT pos AS line_no, prompt, completion, split FROM split",
        ),
        "split_exact": with_(ORDER_SPLIT, query="SELECT id, split, pos FROM split"),
        "assign_splits": with_(ORDER_SPLIT, query="SELECT id, split FROM split"),
        "split_counts": with_(ORDER_SPLIT, query="SELECT split, count(*) AS n_rows FROM split GROUP BY split"),
        "missing_splits": with_(
            split_ctes("SELECT doc_id AS id, source FROM documents", 0.8, 0.02),
            query=f"""SELECT w.source, w.split FROM (SELECT DISTINCT source, s.split FROM split,
                (VALUES {', '.join(f"('{s}')" for s in SPLITS)}) s(split)) w
                WHERE NOT EXISTS (SELECT 1 FROM split p WHERE p.source = w.source AND p.split = w.split)""",
        ),
        "count_gate": "SELECT 1000::BIGINT AS expected, count(*) AS found, count(*) = 1000 AS ok FROM documents",
        "first_n": with_(
            ORDER_SPLIT,
            query=f"SELECT id, pos FROM split WHERE split = 'test' ORDER BY pos LIMIT {A.MAX_EXAMPLES}",
        ),
        "validate_lines": with_(
            checked, query="SELECT id, coalesce(array_to_string(errors, '|'), '') AS errors, non_blank FROM checked"
        ),
        "validate_summary": with_(
            checked,
            query="SELECT sum(len(errors))::BIGINT AS n_errors, sum(non_blank::BIGINT)::BIGINT AS n_lines, "
            "sum(len(errors)) = 0 AS is_valid FROM checked",
        ),
        "validate_by_code": with_(
            checked,
            query="SELECT split_part(e, ':', 1) AS code, split_part(e, ':', 2) AS path, count(*) AS n_errors "
            "FROM (SELECT unnest(errors) AS e FROM checked) u GROUP BY 1, 2",
        ),
        "batch_extract": with_(
            doc_pairs,
            f"prompts AS (SELECT id, CASE {call} WHEN 0 THEN '' WHEN 1 THEN '  ' ELSE prompt END AS prompt FROM pairs)",
            f"asked AS (SELECT id, prompt, {mentioned.replace('{text}', 'prompt')} FROM prompts)",
            query=f"SELECT id, CASE WHEN trim(prompt) = '' THEN '' ELSE {answer} END AS raw_output, "
            "CASE WHEN prompt = '' THEN 'ValueError: empty prompt' END AS error FROM asked",
        ),
        "phrase_extract": with_(
            doc_pairs,
            f"read AS (SELECT id, {mentioned.replace('{text}', 'narrative')} FROM pairs)",
            query=f"SELECT id, {FLAG_LIST}, {severity_case(true_sum())} AS severity FROM read",
        ),
        "evaluate_predictor": with_(
            doc_pairs,
            gold_cte(),
            "judged AS (SELECT id, CASE WHEN json_valid(completion) THEN json_type(completion) = 'OBJECT' "
            "AND completion <> '{}' ELSE false END AS ok FROM gold)",
            f"read AS (SELECT id, {mentioned.replace('{text}', 'prompt')} FROM pairs)",
            "asked AS (SELECT ok, r.*, p.* EXCLUDE (id) RENAME ("
            + ", ".join(f"{f} AS gold_{f}" for f in DAMAGE_FIELDS)
            + ") FROM judged j JOIN read r ON j.id = r.id JOIN pairs p ON p.id = j.id)",
            query="SELECT metric, field, correct, denom, CASE WHEN denom > 0 THEN 100.0::DOUBLE * correct / denom END AS pct FROM ("
            + " UNION ALL ".join(
                ["SELECT 'validity' AS metric, 'json' AS field, count(*) FILTER (ok) AS correct, count(*) AS denom FROM asked"]
                + [
                    f"SELECT 'field_accuracy', '{f}', count(*) FILTER (ok AND {f} = gold_{f}), count(*) FILTER (ok) FROM asked"
                    for f in DAMAGE_FIELDS
                ]
                + ["SELECT 'severity_accuracy', 'overall_severity', 0, count(*) FILTER (ok) FROM asked"]
            )
            + ") l",
        ),
        "pair_gold_pred": with_(
            eval_ctes(),
            query="SELECT id, gold_ok, pred_ok, "
            "CASE WHEN gold_ok THEN json_extract_string(gj, '$.overall_severity') END AS gold_severity, "
            "CASE WHEN pred_ok THEN json_extract_string(pj, '$.overall_severity') END AS pred_severity FROM parsed",
        ),
        "eval_unusable": with_(
            eval_ctes(),
            UNUSABLE,
            query="SELECT side, reason, count(*) AS n_rows FROM reasons WHERE reason IS NOT NULL GROUP BY side, reason",
        ),
        "student_predict": with_(student_ctes(), query=f"SELECT id, {record_text()} AS raw_output FROM predicted"),
        "student_eval": with_(student_ctes(), query=student_report()),
        "json_limits": with_(sized_ctes(), query="SELECT id, status FROM sized"),
        "flatten_rejected": with_(
            sized_ctes(),
            query="SELECT id, replace(status, 'not_json', 'no_json') AS reason FROM sized WHERE status <> 'json'",
        ),
        "eval_report": with_(eval_ctes(), query="SELECT metric, field, correct, denom, pct FROM report"),
        "eval_validity": with_(eval_ctes(), query=metric("validity")),
        "eval_fields": with_(eval_ctes(), query=metric("field_accuracy")),
        "eval_severity": with_(eval_ctes(), query=metric("severity_accuracy")),
        "path_union": with_(
            two_flat(),
            query="SELECT id, path FROM (SELECT id, path FROM fa UNION SELECT id, path FROM fb) u "
            "WHERE id IN (SELECT x.id FROM fa_ok x JOIN fb_ok y ON x.id = y.id)",
        ),
        "compare_paths": with_(two_flat(), COMPARED, query="SELECT id, path, value_a, value_b, is_match FROM compared"),
        "compare_summary": with_(
            two_flat(),
            COMPARED,
            query="SELECT id, count(*) AS keys, sum(is_match::BIGINT)::BIGINT AS matches, "
            "100.0::DOUBLE * sum(is_match::BIGINT) / count(*) AS pct FROM compared GROUP BY id",
        ),
        "compare_mismatches": with_(
            two_flat(),
            COMPARED,
            query="SELECT id, path, value_a, value_b FROM compared WHERE NOT is_match ORDER BY id, path",
        ),
        "compare_models": with_(
            two_flat(),
            COMPARED,
            MODELS,
            query="SELECT id, rejected, keys, matches, CASE WHEN keys > 0 THEN 100.0::DOUBLE * matches / keys END AS pct "
            "FROM models",
        ),
        "model_agreement": with_(
            two_flat(),
            COMPARED,
            MODELS,
            query="SELECT sum((rejected IS NULL)::BIGINT)::BIGINT AS compared, count(rejected) AS rejected, "
            "sum(keys)::BIGINT AS keys, sum(matches)::BIGINT AS matches, "
            "100.0::DOUBLE * sum(matches) / sum(keys) AS pct FROM models",
        ),
        "encode_tokens": with_(encoding_ctes(), query=f"SELECT id, prompt_len, {joined('ids')} AS ids FROM encoded"),
        "encode_with": with_(encoding_ctes(), query=f"SELECT id, prompt_len, {joined('ids')} AS ids FROM encoded"),
        "pad_mask": with_(
            encoding_ctes(),
            query=f"SELECT id, {joined('input_ids')} AS input_ids, {joined('attention_mask')} AS attention_mask FROM padded",
        ),
        "label_mask": with_(encoding_ctes(), query=f"SELECT id, {joined('labels')} AS labels FROM labelled"),
        "all_masked": with_(
            encoding_ctes(),
            query=f"SELECT id FROM labelled WHERE len(list_filter(labels, lambda x: x <> {K.IGNORED_LABEL})) = 0",
        ),
    }
    return sql


ORACLE: dict[str, str] = _build()

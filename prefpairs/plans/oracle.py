"""DuckDB SQL for every registered query (the correctness oracle).

Written as plain SQL over the driver's views, independently of the Spark code: its own
adapter, parser (``trim``/``replace``/``string_split``/``try_cast``/``trunc``), md5
Box-Muller noise with ``round_even``, JSON checks with DuckDB's JSON functions, and
``ORDER BY ... LIMIT`` / ``row_number()`` for prefixes and the exact split.
"""

from __future__ import annotations

from prefpairs import constants as K
from prefpairs.plans import queries as Q
from prefpairs.schema import AUDIT_COUNTERS

WS = "(" + " || ".join(f"chr({ord(c)})" for c in K.PY_WHITESPACE) + ")"
NL = "chr(10)"
# Python's float() and int() literals, written here from the language reference: digit groups
# joined by single underscores, an optional sign, fraction and exponent.
GROUP = "[0-9]+(_[0-9]+)*"
FLOAT_LITERAL = f"[-+]?(({GROUP})([.]({GROUP})?)?|[.]{GROUP})([eE][-+]?{GROUP})?"
INT_LITERAL = f"[-+]?{GROUP}"
TWO48 = "CAST(281474976710656 AS DOUBLE)"
SEED = K.DEFAULT_SEED


def lit(s: str) -> str:
    """SQL string literal (newlines via chr(10))."""
    parts = s.split("\n")
    quoted = ["'" + p.replace("'", "''") + "'" for p in parts]
    return f" || {NL} || ".join(quoted)


def bits48(key_sql: str, *tags: str) -> str:
    msg = f"'{SEED}|' || CAST({key_sql} AS VARCHAR)" + "".join(f" || '|{t}'" for t in tags)
    return f"CAST('0x' || substr(md5({msg}), 1, 12) AS BIGINT)"


def uniform(key_sql: str, *tags: str) -> str:
    return f"((CAST({bits48(key_sql, *tags)} AS DOUBLE) + CAST(0.5 AS DOUBLE)) / {TWO48})"


def gauss(key_sql: str, axis: str) -> str:
    u1, u2 = uniform(key_sql, axis, "1"), uniform(key_sql, axis, "2")
    return f"(sqrt(CAST(-2 AS DOUBLE) * ln({u1})) * cos(CAST(2 AS DOUBLE) * pi() * {u2}))"


# --- sources: each defines CTE ``src(entry_id, n_msgs, user_value, assistant_value)`` ---

def events_src(limit: int | None = None) -> list[str]:
    order = f" ORDER BY event_id LIMIT {limit}" if limit else ""
    wrapped = f"'<image>' || {NL} || 'User: Open item ' || uid || {NL} || 'Model:'"
    return [
        f"""ev0 AS (SELECT event_id AS entry_id, event_type AS kind, CAST(user_id AS VARCHAR) AS uid,
            CAST(floor(value * CAST(10 AS DOUBLE)) AS BIGINT) % 1001 AS xn,
            TRY_CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k
            FROM events{order})""",
        """ev1 AS (SELECT *, CAST(xn AS VARCHAR) AS xs, CAST(k * 10 AS VARCHAR) AS ys FROM ev0)""",
        f"""src AS (SELECT entry_id,
            CASE WHEN entry_id % 89 = 0 THEN 1 ELSE 2 END AS n_msgs,
            CASE WHEN entry_id % 97 = 0 THEN '' WHEN entry_id % 11 = 0 THEN {wrapped} ELSE 'Open item ' || uid END AS user_value,
            CASE WHEN entry_id % 89 = 0 THEN NULL ELSE
              CASE kind
                WHEN 'click' THEN CASE WHEN entry_id % 10 < 7 THEN 'CLICK: (' || xs || ', ' || ys || ')'
                                       WHEN entry_id % 10 = 7 THEN 'CLICK: (' || xs || '.9, ' || ys || '.25)'
                                       WHEN entry_id % 10 = 8 THEN '  CLICK: ((' || xs || ',' || ys || '))  '
                                       ELSE 'CLICK: (' || CAST(xn + 1001 AS VARCHAR) || ', ' || ys || ')' END
                WHEN 'view' THEN 'SCROLL: (' || xs || ', ' || ys || ')'
                WHEN 'signup' THEN CASE WHEN entry_id % 7 = 0 THEN 'TYPE: ""' ELSE 'TYPE: "query ' || CAST(k AS VARCHAR) || '"' END
                WHEN 'purchase' THEN 'LONG_PRESS: (' || xs || ', ' || ys || ')'
                WHEN 'error' THEN CASE WHEN entry_id % 6 = 0 THEN 'COMPLETE' WHEN entry_id % 6 = 1 THEN 'INCOMPLETE'
                                       WHEN entry_id % 6 = 2 THEN 'SWIPE: left' WHEN entry_id % 6 = 3 THEN 'CLICK: (' || xs || ')'
                                       WHEN entry_id % 6 = 4 THEN '' ELSE 'click: (' || xs || ', ' || ys || ')' END
                ELSE '' END
            END AS assistant_value
            FROM ev1)""",
    ]


def conversations_src() -> list[str]:
    return [
        """src AS (SELECT conv_id AS entry_id, least(count(*), 2) AS n_msgs,
            list(text ORDER BY turn)[1] AS user_value,
            list(text ORDER BY turn)[2] AS assistant_value
            FROM conversations GROUP BY conv_id)"""
    ]


def synthetic_src() -> list[str]:
    instr = "[" + ", ".join(lit(s) for s in K.SYNTHETIC_INSTRUCTIONS) + "]"
    acts = "[" + ", ".join(lit(s) for s in K.SYNTHETIC_ACTIONS) + "]"
    idx = "((event_id % 6) + 6) % 6 + 1"
    return [
        f"""src AS (SELECT event_id AS entry_id, 2 AS n_msgs,
            '<image>' || {NL} || 'User: ' || {instr}[{idx}] || {NL} || 'Model:' AS user_value,
            {acts}[{idx}] AS assistant_value
            FROM events)"""
    ]


# --- extraction, parse, pairs ---------------------------------------------------

def shift(shape: str, axis: str, std: float) -> str:
    """The shift of one axis before it is clipped and rounded."""
    if shape == "gauss":
        return f"CAST({std} AS DOUBLE) * {gauss('entry_id', axis)}"
    if shape == "laplace":
        u = f"({uniform('entry_id', axis)} - CAST(0.5 AS DOUBLE))"
        return f"-CAST({std} AS DOUBLE) / sqrt(CAST(2 AS DOUBLE)) * sign({u}) * ln(CAST(1 AS DOUBLE) - CAST(2 AS DOUBLE) * abs({u}))"
    u = uniform("entry_id", "radius")
    if shape == "disc":
        radius = f"CAST({2 * std} AS DOUBLE) * sqrt({u})"
    else:  # the normal's radius below two deviations
        radius = f"CAST({std} AS DOUBLE) * sqrt(CAST(-2 AS DOUBLE) * ln(CAST(1 AS DOUBLE) - (CAST(1 AS DOUBLE) - exp(CAST(-2 AS DOUBLE))) * {u}))"
    turn = {"x": "cos", "y": "sin"}[axis]
    return f"{radius} * {turn}(CAST(2 AS DOUBLE) * pi() * {uniform('entry_id', 'angle')})"


def chain(src: list[str], valid_limit: int | None = None, noise_std: float = K.DEFAULT_NOISE_STD, shape: str = "gauss") -> list[str]:
    limit = f" ORDER BY entry_id LIMIT {valid_limit}" if valid_limit else ""
    coord_tags = "('CLICK', 'LONG_PRESS', 'SCROLL')"
    num = lambda t: (
        f"CASE WHEN regexp_full_match({t}, '{FLOAT_LITERAL}') "
        f"THEN TRY_CAST(trunc(TRY_CAST(replace({t}, '_', '') AS DOUBLE)) AS BIGINT) END"
    )
    movable = "action_type IN ('CLICK', 'LONG_PRESS') AND x IS NOT NULL AND y IS NOT NULL"
    w, h = K.DEFAULT_CANVAS
    moved = lambda axis, col, size: (
        f"CASE WHEN {movable} THEN CAST(round_even(greatest(CAST(0 AS DOUBLE), least(CAST({size} AS DOUBLE), "
        f"CAST({col} AS DOUBLE) + {shift(shape, axis, noise_std)})), 0) AS BIGINT) END"
    )
    chosen = (
        f"CASE WHEN action_type IN {coord_tags} THEN "
        f"  CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN action_type || ': (' || CAST(x AS VARCHAR) || ', ' || CAST(y AS VARCHAR) || ')' "
        f"  ELSE action_type || ': (0, 0)' END "
        f"WHEN action_type = 'TYPE' THEN CASE WHEN text IS NOT NULL AND text <> '' THEN 'TYPE: \"' || text || '\"' ELSE 'TYPE: \"\"' END "
        f"WHEN action_type IN ('COMPLETE', 'INCOMPLETE') THEN action_type ELSE 'STOP' END"
    )
    logical = (
        f"CASE WHEN action_type = 'CLICK' THEN {lit(K.LOGICAL_FOR_CLICK)} "
        f"WHEN action_type = 'TYPE' THEN {lit(K.LOGICAL_FOR_TYPE)} ELSE {lit(K.LOGICAL_DEFAULT)} END"
    )
    return src + [
        f"""ext AS (SELECT entry_id, reason0,
            CASE WHEN reason0 IS NULL THEN trim(user_value, {WS}) END AS instruction,
            CASE WHEN reason0 IS NULL THEN trim(assistant_value, {WS}) END AS raw_action
            FROM (SELECT *, CASE WHEN coalesce(n_msgs, 0) < 2 THEN 'too_few_messages'
                                 WHEN NOT coalesce(user_value <> '' AND assistant_value <> '', false) THEN 'empty_message' END AS reason0
                  FROM src))""",
        f"""pa1 AS (SELECT *, trim(raw_action, {WS}) AS s FROM ext)""",
        """pa2 AS (SELECT *, CASE WHEN starts_with(s, 'CLICK:') THEN 'CLICK' WHEN starts_with(s, 'LONG_PRESS:') THEN 'LONG_PRESS'
            WHEN starts_with(s, 'TYPE:') THEN 'TYPE' WHEN starts_with(s, 'SCROLL:') THEN 'SCROLL'
            WHEN starts_with(s, 'COMPLETE') THEN 'COMPLETE' WHEN starts_with(s, 'INCOMPLETE') THEN 'INCOMPLETE' END AS tag FROM pa1)""",
        f"""pa3 AS (SELECT *, trim(replace(s, tag || ':', ''), {WS}) AS body FROM pa2)""",
        """pa4 AS (SELECT *, string_split(trim(body, '()'), ',') AS parts FROM pa3)""",
        f"""pa5 AS (SELECT *, CASE WHEN len(parts) = 2 THEN trim(parts[1], {WS}) END AS t0,
                              CASE WHEN len(parts) = 2 THEN trim(parts[2], {WS}) END AS t1 FROM pa4)""",
        f"""pa6 AS (SELECT *, {num('t0')} AS nx, {num('t1')} AS ny FROM pa5)""",
        f"""pa7 AS (SELECT *, tag IN {coord_tags} AND nx IS NOT NULL AND ny IS NOT NULL AS coord_ok FROM pa6)""",
        """parsed0 AS (SELECT entry_id, instruction, raw_action, reason0,
            CASE WHEN coord_ok THEN tag WHEN tag = 'TYPE' THEN tag WHEN tag IN ('COMPLETE', 'INCOMPLETE') THEN tag END AS action_type,
            CASE WHEN coord_ok THEN nx END AS x, CASE WHEN coord_ok THEN ny END AS y,
            CASE WHEN tag = 'TYPE' THEN trim(body, '"''') END AS text FROM pa7)""",
        """parsed AS (SELECT entry_id, instruction, raw_action, action_type, x, y, text,
            coalesce(reason0, CASE WHEN action_type IS NULL THEN 'unparseable_action' END) AS skip_reason FROM parsed0)""",
        f"""vp AS (SELECT entry_id, action_type, x, y, text,
            '<image>' || {NL} || 'User: ' || instruction || {NL} || 'Model:' AS prompt,
            {chosen} AS chosen
            FROM parsed WHERE skip_reason IS NULL{limit})""",
        f"""sp1 AS (SELECT *, {moved('x', 'x', w)} AS rx, {moved('y', 'y', h)} AS ry FROM vp)""",
        f"""sp2 AS (SELECT *, CASE WHEN rx = x AND ry = y THEN ((x + 10) % {int(w)} + {int(w)}) % {int(w)} ELSE rx END AS fx FROM sp1)""",
        f"""spatial AS (SELECT entry_id, CAST(0 AS BIGINT) AS strategy_ord, prompt, chosen,
            CASE WHEN {movable} THEN action_type || ': (' || CAST(fx AS VARCHAR) || ', ' || CAST(ry AS VARCHAR) || ')' ELSE chosen END AS rejected,
            action_type, 'spatial' AS rejection_strategy, '{K.DEFAULT_SOURCE}' AS source FROM sp2)""",
        f"""logical AS (SELECT entry_id, CAST(1 AS BIGINT) AS strategy_ord, prompt, chosen, {logical} AS rejected,
            action_type, 'logical' AS rejection_strategy, '{K.DEFAULT_SOURCE}' AS source FROM vp)""",
        """pairs AS (SELECT * FROM spatial UNION ALL SELECT * FROM logical)""",
    ]


def with_(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def family(a: str) -> str:
    return (
        f"CASE WHEN contains({a}, 'CLICK:') THEN 'action_click' WHEN contains({a}, 'TYPE:') THEN 'action_type' "
        f"WHEN contains({a}, 'LONG_PRESS:') THEN 'action_long_press' WHEN contains({a}, 'SCROLL:') THEN 'action_scroll' END"
    )


def coord_check_ctes(acts_cte: str) -> list[str]:
    """From ``acts_cte(..., a)`` to ``ac3(..., a, ok)``: ok TRUE/FALSE/NULL as the audit counts."""
    w, h = K.DEFAULT_CANVAS
    return [
        f"""ac1 AS (SELECT *, coalesce((contains(a, 'CLICK:') OR contains(a, 'LONG_PRESS:')) AND contains(a, '('), false) AS looked,
            string_split(split_part(split_part(a, '(', 2), ')', 1), ',') AS cparts FROM {acts_cte})""",
        f"""ac2 AS (SELECT *, CASE WHEN looked AND len(cparts) = 2 THEN trim(cparts[1], {WS}) END AS c0,
                              CASE WHEN looked AND len(cparts) = 2 THEN trim(cparts[2], {WS}) END AS c1 FROM ac1)""",
        f"""ac3 AS (SELECT *, CASE WHEN regexp_full_match(c0, '{INT_LITERAL}') AND regexp_full_match(c1, '{INT_LITERAL}') THEN
              coalesce(TRY_CAST(replace(c0, '_', '') AS BIGINT) BETWEEN 0 AND {w}
                       AND TRY_CAST(replace(c1, '_', '') AS BIGINT) BETWEEN 0 AND {h}, false) END AS ok FROM ac2)""",
    ]


def audit_sql(lines_cte: str) -> str:
    ctes = [
        lines_cte,
        """cl0 AS (SELECT line, coalesce(json_valid(line), false) AS ok FROM lines)""",
        """cl AS (SELECT line, CASE WHEN NOT ok THEN 'json_error'
                  WHEN json_type(line) = 'OBJECT' AND list_contains(json_keys(line), 'prompt')
                       AND list_contains(json_keys(line), 'chosen') AND list_contains(json_keys(line), 'rejected') THEN 'valid'
                  ELSE 'invalid' END AS kind FROM cl0)""",
        """cl2 AS (SELECT kind,
            CASE WHEN kind = 'valid' AND json_type(line, '$.chosen') = 'VARCHAR' THEN line ->> '$.chosen' END AS c,
            CASE WHEN kind = 'valid' AND json_type(line, '$.rejected') = 'VARCHAR' THEN line ->> '$.rejected' END AS r
            FROM cl)""",
        """acts AS (SELECT c AS a FROM cl2 WHERE kind = 'valid' UNION ALL SELECT r AS a FROM cl2 WHERE kind = 'valid')""",
        *coord_check_ctes("acts"),
    ]
    fam = family("a")
    select = f"""SELECT
        (SELECT count(*) FROM cl WHERE kind = 'valid') AS valid_pairs,
        (SELECT count(*) FROM cl WHERE kind = 'invalid') AS invalid_pairs,
        (SELECT count(*) FROM cl WHERE kind = 'json_error') AS json_errors,
        (SELECT count(*) FROM ac3 WHERE ok) AS valid_coords,
        (SELECT count(*) FROM ac3 WHERE NOT ok) AS invalid_coords,
        (SELECT count(*) FROM ac3 WHERE {fam} = 'action_click') AS action_click,
        (SELECT count(*) FROM ac3 WHERE {fam} = 'action_type') AS action_type,
        (SELECT count(*) FROM ac3 WHERE {fam} = 'action_long_press') AS action_long_press,
        (SELECT count(*) FROM ac3 WHERE {fam} = 'action_scroll') AS action_scroll"""
    return with_(ctes, select)


PAIR_LINE = "json_object('prompt', prompt, 'chosen', chosen, 'rejected', rejected)::VARCHAR"

FAULT_LINE = """CASE WHEN event_id % 6 = 0 THEN '{"prompt": "p' || CAST(event_id AS VARCHAR) || '"}'
    WHEN event_id % 6 = 1 THEN ''
    WHEN event_id % 6 = 2 THEN '{"prompt": "p", "chosen": "CLICK: (' || CAST(event_id AS VARCHAR) || ', 1)"'
    WHEN event_id % 6 = 3 THEN '[' || CAST(event_id AS VARCHAR) || ']'
    WHEN event_id % 6 = 4 THEN '{"prompt": "p", "chosen": "x", "rejected": "y"} ' || CAST(event_id AS VARCHAR)
    ELSE '{"prompt": null, "chosen": "CLICK: (' || CAST(CAST(floor(value * CAST(10 AS DOUBLE)) AS BIGINT) % 1001 AS VARCHAR)
         || ', 5)", "rejected": "LONG_PRESS: (' || CAST(CAST(floor(value * CAST(10 AS DOUBLE)) AS BIGINT) % 1001 + 1001 AS VARCHAR) || ', 7)"}' END"""


def _pairs_cols() -> str:
    return "entry_id, strategy_ord, prompt, chosen, rejected, action_type, rejection_strategy, source"


def build() -> dict[str, str]:
    ev = chain(events_src())
    sql: dict[str, str] = {}
    sql["entries_extracted"] = with_(ev, "SELECT entry_id, instruction, raw_action FROM ext WHERE reason0 IS NULL")
    sql["entries_from_conversations"] = with_(
        chain(conversations_src()), "SELECT entry_id, instruction, raw_action FROM ext WHERE reason0 IS NULL"
    )
    sql["actions_parsed"] = with_(ev, "SELECT entry_id, action_type, x, y, text, skip_reason FROM parsed")
    sql["actions_canonical"] = with_(ev, "SELECT entry_id, action_type, chosen FROM vp")
    sql["prompts_built"] = with_(ev, "SELECT entry_id, prompt FROM vp")
    sql["rejections_spatial"] = with_(ev, "SELECT entry_id, chosen, rejected FROM spatial")
    sql["rejections_logical"] = with_(ev, "SELECT entry_id, chosen, rejected FROM logical")
    sql["pairs_all"] = with_(ev, f"SELECT {_pairs_cols()} FROM pairs")
    sql["generation_stats"] = with_(
        ev,
        """SELECT count(*) FILTER (WHERE skip_reason IS NOT NULL) AS skipped_invalid,
                  count(*) FILTER (WHERE skip_reason IS NULL) AS pairs_spatial,
                  count(*) FILTER (WHERE skip_reason IS NULL) AS pairs_logical FROM parsed""",
    )
    sql["sample_raw_prefix"] = with_(chain(events_src(limit=Q.RAW_PREFIX_N)), f"SELECT {_pairs_cols()} FROM pairs")
    sql["sample_valid_cap"] = with_(chain(events_src(), valid_limit=Q.VALID_CAP_N), f"SELECT {_pairs_cols()} FROM pairs")
    sql["audit_pairs"] = audit_sql(
        "lines AS (" + with_(ev, f"SELECT {PAIR_LINE} AS line FROM pairs")
        + f" UNION ALL SELECT {FAULT_LINE} AS line FROM events WHERE event_type = 'error')"
    )
    sql["action_distribution"] = with_(
        ev,
        f"""SELECT family, count(*) AS n FROM (
              SELECT {family('chosen')} AS family FROM pairs UNION ALL SELECT {family('rejected')} AS family FROM pairs)
            WHERE family IS NOT NULL GROUP BY family""",
    )
    sql["coords_out_of_range"] = with_(
        ev
        + [
            """pacts AS (SELECT entry_id, strategy_ord, 'chosen' AS side, chosen AS a FROM pairs
                UNION ALL SELECT entry_id, strategy_ord, 'rejected' AS side, rejected AS a FROM pairs)"""
        ]
        + coord_check_ctes("pacts"),
        "SELECT entry_id, strategy_ord, side, a AS action FROM ac3 WHERE ok = false",
    )
    sft = f"prompt || chosen || {lit(K.END_OF_TURN)}"
    sql["sft_text"] = with_(ev, f"SELECT entry_id, strategy_ord, {sft} AS text FROM pairs")
    sql["dpo_projection"] = with_(ev, "SELECT prompt, chosen, rejected FROM pairs")
    sql["max_samples_prefix"] = with_(
        ev,
        f"SELECT entry_id, strategy_ord, prompt, chosen, rejected FROM pairs ORDER BY entry_id, strategy_ord LIMIT {Q.MAX_SAMPLES_M}",
    )
    frac = f"(CAST({bits48('entry_id', 'split')} AS DOUBLE) / {TWO48})"
    sql["train_eval_split"] = with_(
        ev,
        f"""SELECT entry_id, strategy_ord, {sft} AS text,
                   CASE WHEN {frac} < CAST({K.DEFAULT_SPLIT_RATIO} AS DOUBLE) THEN 'train' ELSE 'eval' END AS split
            FROM pairs""",
    )
    sql["split_exact"] = with_(
        ev,
        f"""SELECT entry_id, strategy_ord, prompt, chosen, rejected,
                   CASE WHEN row_number() OVER (ORDER BY {bits48('entry_id', 'split')} DESC, entry_id, strategy_ord) <= {Q.SPLIT_N_EVAL}
                        THEN 'eval' ELSE 'train' END AS split
            FROM pairs""",
    )
    dw, dh = Q.DEVICE_SIZE
    cw, ch = K.DEFAULT_CANVAS
    sql["pixels"] = with_(
        ev,
        f"""SELECT entry_id, action_type,
                   CAST(x AS DOUBLE) / CAST({cw} AS DOUBLE) * CAST({dw} AS DOUBLE) AS px,
                   CAST(y AS DOUBLE) / CAST({ch} AS DOUBLE) * CAST({dh} AS DOUBLE) AS py
            FROM parsed WHERE skip_reason IS NULL AND x IS NOT NULL""",
    )
    sql["synthetic_pairs"] = with_(chain(synthetic_src()), f"SELECT {_pairs_cols()} FROM pairs")
    sql["jsonl_roundtrip"] = sql["dpo_projection"]
    sql["jsonl_audit"] = audit_sql("lines AS (" + with_(ev, f"SELECT {PAIR_LINE} AS line FROM pairs") + ")")
    sql["pairs_streamed"] = sql["pairs_in_batches"] = sql["pairs_all"]
    sql["jsonl_ordered"] = with_(ev, "SELECT row_number() OVER (ORDER BY entry_id, strategy_ord) - 1 AS line, prompt, chosen, rejected FROM pairs")
    pretty = (
        f"'{{' || {NL} || '  \"prompt\" : ' || to_json(prompt) || ',' || {NL} || '  \"chosen\" : ' || to_json(chosen) "
        f"|| ',' || {NL} || '  \"rejected\" : ' || to_json(rejected) || {NL} || '}}'"
    )
    sql["peek"] = with_(
        ev,
        f"""SELECT entry_id, strategy_ord, {pretty} AS json FROM pairs
            ORDER BY entry_id, strategy_ord LIMIT {Q.PEEK_N}""",
    )
    # Tables written out and read back give what went in.
    extracted = "SELECT entry_id, instruction, raw_action FROM ext WHERE reason0 IS NULL"
    sql["entries_json_lines"] = with_(ev, "SELECT entry_id, instruction, raw_action, true AS in_order FROM ext WHERE reason0 IS NULL")
    for name in ("entries_json_array", "entries_parquet", "source_fallback"):
        sql[name] = with_(ev, extracted)
    sql["entries_slice"] = with_(ev, f"{extracted} AND entry_id BETWEEN {Q.SLICE[0]} AND {Q.SLICE[1]}")
    sql["entries_faults"] = """SELECT CASE event_id % 8 WHEN 0 THEN 'valid' WHEN 4 THEN 'empty_message' WHEN 6 THEN 'too_few_messages'
               WHEN 5 THEN 'malformed_record' WHEN 7 THEN 'malformed_record' ELSE 'non_text_message' END AS outcome, count(*) AS n
        FROM events GROUP BY outcome"""
    sql["pairs_jsonl_faults"] = with_(
        ev,
        """SELECT fault, count(*) AS n FROM (
             SELECT 'none' AS fault FROM pairs UNION ALL
             SELECT CASE event_id % 6 WHEN 0 THEN 'missing_key' WHEN 3 THEN 'missing_key' WHEN 5 THEN 'non_text' ELSE 'json_error' END AS fault
             FROM events WHERE event_type = 'error' AND event_id % 6 <> 1)
           GROUP BY fault""",
    )
    sql["jsonl_max_samples"] = with_(ev, f"SELECT prompt, chosen, rejected FROM pairs ORDER BY entry_id, strategy_ord LIMIT {Q.MAX_SAMPLES_M}")
    content = "sha256(prompt || chr(1) || chosen)"
    sql["jsonl_split_exact"] = with_(
        ev,
        f"""SELECT prompt, chosen, rejected,
                   CASE WHEN row_number() OVER (ORDER BY {bits48(content, 'split')} DESC, entry_id, strategy_ord) <= {Q.SPLIT_N_EVAL}
                        THEN 'eval' ELSE 'train' END AS split
            FROM pairs""",
    )
    row = "CAST(entry_id AS VARCHAR) || '-' || CAST(strategy_ord AS VARCHAR)"
    row_frac = f"(CAST({bits48(row, 'split')} AS DOUBLE) / {TWO48})"
    sql["train_eval_split_rows"] = with_(
        ev,
        f"""SELECT entry_id, strategy_ord, {sft} AS text,
                   CASE WHEN {row_frac} < CAST({K.DEFAULT_SPLIT_RATIO} AS DOUBLE) THEN 'train' ELSE 'eval' END AS split
            FROM pairs""",
    )
    sql["pairs_table_logical"] = with_(ev, "SELECT entry_id, prompt, chosen, rejected, source FROM logical")
    sql["summary_report"] = sql["jsonl_audit"]
    sql["prepared_counts"] = with_(
        ev,
        f"""SELECT split, count(*) AS n FROM (
              SELECT CASE WHEN {frac} < CAST({K.DEFAULT_SPLIT_RATIO} AS DOUBLE) THEN 'train' ELSE 'eval' END AS split FROM pairs)
            GROUP BY split""",
    )
    sql["preview"] = with_(
        ev,
        f"""SELECT entry_id, strategy_ord, left(prompt, 12) AS prompt, left(chosen, 12) AS chosen, left(rejected, 12) AS rejected
            FROM pairs ORDER BY entry_id, strategy_ord LIMIT {Q.PEEK_N}""",
    )
    sql["rejections_no_noise"] = with_(chain(events_src(), noise_std=0.0), "SELECT entry_id, chosen, rejected FROM spatial")
    sql["rejections_custom"] = with_(
        ev,
        """SELECT entry_id, chosen, CASE WHEN x IS NOT NULL THEN action_type || ': (' || CAST(y AS VARCHAR) || ', ' || CAST(x AS VARCHAR) || ')'
                  ELSE chosen END AS rejected FROM vp""",
    )
    zero = lambda names: ", ".join(f"CAST(0 AS BIGINT) AS {c}" for c in names)
    sql["audit_uncounted"] = f"""SELECT 'unreadable' AS input, count(*) AS valid_pairs, {zero(AUDIT_COUNTERS[1:5])}, count(*) AS action_click,
            CAST(0 AS BIGINT) AS action_type, count(*) AS action_long_press, CAST(0 AS BIGINT) AS action_scroll FROM events
        UNION ALL SELECT 'empty' AS input, {zero(AUDIT_COUNTERS)}"""
    # What each line means follows from how it was built.
    kind = lambda *k: f"count(*) FILTER (event_id % 6 IN ({', '.join(map(str, k))}))"
    sql["audit_bare_numbers"] = f"""SELECT {kind(0, 1)} AS valid_pairs, {kind(2)} AS invalid_pairs, {kind(3, 4, 5)} AS json_errors,
            {kind(0)} AS valid_coords, CAST(0 AS BIGINT) AS invalid_coords, {kind(0)} AS action_click, {kind(0)} AS action_type,
            CAST(0 AS BIGINT) AS action_long_press, {kind(1)} AS action_scroll FROM events"""
    # What each notation means follows from how it was built.
    sql["actions_hard"] = """WITH t AS (SELECT conv_id * 1000 + turn AS entry_id, conv_id, turn, text, (conv_id + turn) % 7 AS k FROM conversations)
        SELECT entry_id,
               CASE WHEN k IN (1, 6) AND text IS NULL THEN NULL ELSE CASE k WHEN 0 THEN 'CLICK' WHEN 1 THEN 'TYPE' WHEN 2 THEN 'TYPE' WHEN 3 THEN 'SCROLL' WHEN 4 THEN 'LONG_PRESS' WHEN 5 THEN 'CLICK' ELSE 'INCOMPLETE' END END AS action_type,
               CASE k WHEN 0 THEN conv_id * 10 WHEN 3 THEN conv_id WHEN 4 THEN 1000 + turn WHEN 5 THEN 12 END AS x,
               CASE k WHEN 0 THEN 0 WHEN 3 THEN -turn WHEN 4 THEN conv_id WHEN 5 THEN 3 END AS y,
               CASE k WHEN 1 THEN trim(text, chr(34) || chr(39)) WHEN 2 THEN 'say "' || CAST(turn AS VARCHAR) || '" twice' END AS text
        FROM t"""
    one = "SELECT min(entry_id) AS entry_id, text FROM t GROUP BY text"
    sql["sft_deduplicated"] = with_(
        [*ev, f"t AS (SELECT entry_id, strategy_ord, {sft} AS text FROM pairs)", f"d AS ({one})",
         "f AS (SELECT d.entry_id, min(t.strategy_ord) AS strategy_ord, d.text FROM d JOIN t ON d.text = t.text AND d.entry_id = t.entry_id GROUP BY d.entry_id, d.text)"],
        f"""SELECT entry_id, strategy_ord, text,
                   CASE WHEN row_number() OVER (ORDER BY {bits48('sha256(text)', 'split')} DESC, entry_id, strategy_ord) <= {Q.SPLIT_N_EVAL}
                        THEN 'eval' ELSE 'train' END AS split
            FROM f""",
    )
    for shape in ("disc", "laplace", "truncated"):
        sql[f"rejections_{shape}"] = with_(chain(events_src(), shape=shape), "SELECT entry_id, chosen, rejected FROM spatial")
    sql["entries_adapted"] = """SELECT CAST(doc_id AS BIGINT) AS entry_id, 'Label document ' || CAST(doc_id AS VARCHAR) AS instruction,
               'CLICK: (' || CAST(quality AS VARCHAR) || ', ' || CAST(toxic AS VARCHAR) || ')' AS raw_action FROM labels"""
    sql["train_eval_split_streamed"] = sql["train_eval_split"]
    sql["generation_stats_streamed"] = sql["generation_stats"]
    sql["audit_streamed"] = sql["jsonl_audit"]
    return sql


ORACLE_SQL = build()

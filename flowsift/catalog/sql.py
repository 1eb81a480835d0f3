"""The views of flowsift.sources.views as SQL, for the reference queries."""

from __future__ import annotations

from collections.abc import Sequence

from flowsift.schema import LABELS
from flowsift.sources.views import COMMANDS, FLOW_COLS, FLOW_KEYS, RAW_LABELS, SIGNAL_COLS, class_factor


def text(value: object) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def draw_key(keys: Sequence[str], *salt: object) -> str:
    return f"md5(concat_ws('|', {', '.join([*keys, *[text(s) for s in salt]])}))"


def unit_draw(keys: Sequence[str], *salt: object) -> str:
    return f"(CAST('0x' || substr({draw_key(keys, *salt)}, 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)"


def index_draw(keys: Sequence[str], size: str, *salt: object) -> str:
    return f"CAST(floor({unit_draw(keys, *salt)} * ({size})) AS BIGINT)"


def commas(cols: Sequence[str], prefix: str = "") -> str:
    return ", ".join(prefix + c for c in cols)


def finite(c: str) -> str:
    return f"CASE WHEN isfinite({c}) THEN {c} END"


def _choice(values: Sequence[str], index: str) -> str:
    return f"([{', '.join(values)}])[({index}) + 1]"


_raw = "CASE " + " ".join(
    f"WHEN label = {text(cls)} THEN {_choice([text(s) for s in spellings], f'k_supp % {len(spellings)}')}"
    for cls, spellings in RAW_LABELS
) + " END"

_profile = ", ".join(
    f"({text(cls)}, " + ", ".join(f"{class_factor(cls, c)}::DOUBLE" for c in SIGNAL_COLS) + ")"
    for cls in LABELS
)

_command_list = [text(c) for c, _ in COMMANDS]
_flag_list = [f"{m}::BIGINT" for _, m in COMMANDS]
EVENT_K = "CAST(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS INTEGER)"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "flows": (
        (),
        """
        SELECT l_orderkey AS k_order, l_partkey AS k_part, l_suppkey AS k_supp,
               CAST(l_linenumber AS BIGINT) AS k_line,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS k_cents,
               CAST(l_partkey % 65535 AS DOUBLE) AS port, l_quantity AS duration,
               l_extendedprice AS bytes, l_discount AS discount, l_tax AS tax,
               o_totalprice AS total_price, CAST(l_suppkey AS DOUBLE) AS supplier,
               CAST(l_linenumber AS DOUBLE) AS line_no,
               CASE WHEN l_discount = 0 THEN CAST('inf' AS DOUBLE) ELSE l_extendedprice / l_discount END AS byte_rate,
               CASE WHEN l_tax = 0 THEN CAST('nan' AS DOUBLE) ELSE l_quantity / l_tax END AS packet_rate,
               CASE WHEN l_partkey % 100 < 75 THEN 'BENIGN' WHEN l_partkey % 100 < 84 THEN 'DoS'
                    WHEN l_partkey % 100 < 90 THEN 'DDoS' WHEN l_partkey % 100 < 95 THEN 'PortScan'
                    WHEN l_partkey % 100 < 97 THEN 'Brute Force' WHEN l_partkey % 100 < 98 THEN 'Web Attack'
                    WHEN l_partkey % 100 < 99 THEN 'Botnet' ELSE 'Infiltration' END AS label
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "folded": (
        ("flows",),
        f"""
        SELECT {commas(FLOW_KEYS)}, {', '.join(f'{finite(c)} AS {c}' for c in FLOW_COLS)}, label FROM flows""",
    ),
    "flows_dup": (("flows",), "SELECT * FROM flows UNION ALL SELECT * FROM flows WHERE discount = 0"),
    "raw_labels": (("flows",), f"SELECT *, {_raw} AS raw_label FROM flows"),
    "profile": ((), f"SELECT * FROM (VALUES {_profile}) AS t(class, {commas(SIGNAL_COLS)})"),
    "payloads": (
        (),
        f"""
        SELECT doc_id, concat_ws(' ', {_choice(_command_list, f'doc_id % {len(COMMANDS)}')}, text) AS payload,
               {_choice(_flag_list, f'doc_id % {len(COMMANDS)}')} AS label, lang, source
        FROM documents""",
    ),
    "scored": (
        (),
        f"""
        SELECT event_id, event_type, CAST(event_type = 'error' AS INTEGER) AS y, value / (value + 50) AS score,
               CASE event_type WHEN 'error' THEN 'DoS' WHEN 'purchase' THEN 'PortScan' ELSE 'BENIGN' END AS truth,
               CASE WHEN value > 60 THEN 'DoS' WHEN {EVENT_K} > 70 THEN 'PortScan' ELSE 'BENIGN' END AS predicted
        FROM events""",
    ),
    "scores3": (
        (),
        f"""
        SELECT event_id, event_type, CAST(event_type = 'error' AS INTEGER) AS y, value * 1000 AS anomaly_score,
               value / (value + 50) AS attack_proba, {EVENT_K} / 100.0::DOUBLE AS text_proba
        FROM events""",
    ),
    "events_in": (
        (),
        f"""
        SELECT event_id, ts, event_type, event_type NOT IN ('click', 'signup') AS has_features,
               CASE WHEN event_type NOT IN ('click', 'signup') THEN value END AS duration,
               CASE WHEN event_type NOT IN ('click', 'signup') THEN CAST({EVENT_K} AS DOUBLE) END AS line_no,
               CASE WHEN event_type NOT IN ('view', 'click')
                    THEN {_choice(_command_list, f'{EVENT_K} % {len(COMMANDS)}')} END AS payload
        FROM events""",
    ),
    "vectors": ((), "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CAST(label = 0 AS INTEGER) AS y FROM embeddings"),
    "versions": ((), "SELECT p_brand AS name, CAST(p_size AS VARCHAR) AS version FROM part"),
    "aliases": (
        (),
        """
        SELECT p_brand AS name, 'production' AS alias, CAST(min(p_size) AS BIGINT) AS version FROM part GROUP BY 1
        UNION ALL
        SELECT p_brand, 'staging', CAST(min(p_size) AS BIGINT) FROM part WHERE p_type = 'ECONOMY' GROUP BY 1""",
    ),
}


def with_views(body: str, *views: str, **more: str) -> str:
    """``body`` preceded by the named views, their inputs, and further named subqueries."""
    wanted: list[str] = []

    def need(name: str) -> None:
        for dep in VIEWS[name][0]:
            need(dep)
        if name not in wanted:
            wanted.append(name)

    for v in views:
        need(v)
    parts = [f"{v} AS ({VIEWS[v][1]})" for v in wanted] + [f"{k} AS ({v})" for k, v in more.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def split_case(n_test: str = "0.2", n_val: str = "0.1") -> str:
    """Split name from rank ``rk`` and stratum size ``n``."""
    test = f"floor(n * {n_test}::DOUBLE + 0.5::DOUBLE)"
    val = f"floor(n * {n_val}::DOUBLE + 0.5::DOUBLE)"
    return f"CASE WHEN rk <= {test} THEN 'test' WHEN rk <= {test} + {val} THEN 'val' ELSE 'train' END"


def split_of(source: str, seed: int = 42, keys: Sequence[str] = FLOW_KEYS, strata: str = "label") -> str:
    """Rows of ``source`` with their exact stratified split."""
    return f"""
        SELECT * EXCLUDE (rk, n), {split_case()} AS split FROM (
            SELECT *, row_number() OVER (PARTITION BY {strata} ORDER BY {draw_key(keys, seed)}) AS rk,
                   count(*) OVER (PARTITION BY {strata}) AS n
            FROM {source})"""

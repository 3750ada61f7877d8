"""Rule-based scoring of generated YAML configurations against the three
configuration rubrics (network slice, AMF, subscriber profile).

Plan: parse each submission and its reference once per row (the one Python
step, on Arrow batches) into a map path -> (value, type) holding only the
paths the rubric reads -> every criterion is a native expression over map
lookups -> sum x 100 / max. It is a single narrow stage: no shuffle.
``flatten_yaml`` gives the same nodes as rows, for relational use.

Criteria score 5 / 3 / 1. A document that cannot be parsed scores 1 on
every criterion (the rubric floor, 20). Readings of the rubric text that it
leaves open are ours and are stated next to each criterion.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- flatten (Python inside Arrow batches) ---------------------------------------

def _vtype(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int"
    if isinstance(v, float):
        return "float"
    if isinstance(v, str):
        return "str"
    return type(v).__name__


def _text(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return "true" if v else "false"
    return v if isinstance(v, str) else (v.isoformat() if hasattr(v, "isoformat") else str(v))


def _key(k) -> str:
    """A mapping key as a path part; dots and brackets of its own are escaped."""
    return re.sub(r"([\\.\[])", r"\\\1", str(k))


_JSON = json.JSONEncoder(default=str)


def _node(v) -> tuple[str | None, str]:
    """(text, type) of one node."""
    if isinstance(v, dict):
        return None, "map"
    if isinstance(v, list):
        flat = all(not isinstance(x, (dict, list)) for x in v)
        return (_JSON.encode(v) if flat else None), "list"
    return _text(v), _vtype(v)


def _walk(root) -> list[tuple[str, str | None, str]]:
    """Every node in document order. A mapping or list that recurs through an alias is listed where it recurs and entered once,
    so neither cycles nor repeated aliases grow the result."""
    out, todo, entered = [], [("", root)], set()
    while todo:
        path, node = todo.pop()
        out.append((path, *_node(node)))
        if not isinstance(node, (dict, list)) or id(node) in entered:
            continue
        entered.add(id(node))
        if isinstance(node, dict):
            children = [(f"{path}.{_key(k)}" if path else _key(k), v) for k, v in node.items()]
        else:
            children = [(f"{path}[{i}]", v) for i, v in enumerate(node)]
        todo.extend(reversed(children))
    return out


_STEP = re.compile(r"\[(\d+)\]|((?:\\.|[^.\[\\])+)")


def _steps(path: str) -> list[int | str]:
    return [int(i) if i else re.sub(r"\\(.)", r"\1", k) for i, k in _STEP.findall(path)]


def _tree(paths: Sequence[str]) -> tuple:
    """The paths as a tree: ([(place in ``paths``, path)] that end here, subtrees by key, subtrees by list index)."""
    root: tuple = ([], {}, {})
    for no, path in enumerate(paths):
        at = root
        for step in _steps(path):
            at = at[2 if isinstance(step, int) else 1].setdefault(step, ([], {}, {}))
        at[0].append((no, path))
    return root


def _take(doc, tree: tuple) -> list[tuple[int, str, str | None, str]]:
    """(place, path, text, type) of the tree's paths that the document has, in the order of the paths. Only branches that both have are entered."""
    out, todo = [], [(doc, tree)]
    while todo:
        node, (ends, keys, places) = todo.pop()
        kind = type(node)
        if ends:
            text, vtype = (node, "str") if kind is str else (str(node), "int") if kind is int else _node(node)
            for no, path in ends:
                out.append((no, path, text, vtype))
        if keys and isinstance(node, dict):
            if len(node) < len(keys):
                todo += [(v, keys[k]) for k, v in node.items() if k in keys]
            else:
                todo += [(node[k], below) for k, below in keys.items() if k in node]
        elif places and isinstance(node, list):
            for i, below in places.items():
                if i < len(node):
                    todo.append((node[i], below))
    out.sort()
    return out


# A line of a plain block document: indent, "- ", "key:", then nothing, a plain scalar, a quoted one without escapes or a list of plain scalars, and a comment.
_WORD = r"[A-Za-z0-9_./+-]++(?::[A-Za-z0-9_./+-]++)*+"
_LINE = re.compile(r"^( *+)(- )?(?:([A-Za-z_][A-Za-z0-9_./-]{0,99}+):(?: ++|$))?"
                   rf"""(?:((?!-){_WORD}(?: ++{_WORD})*+)|("[ !#-\[\]-~]*+"|'[ -&(-~]*+'|\[[A-Za-z0-9_./ ,]*+\]))? *+(?:(?<![^ \n])#[ -~]*+)?$""", re.M)
_ITEM = re.compile(r"[A-Za-z0-9_./]+")
# What YAML may read as more than text, drawn wide: numbers, times, truth values and null.
_NUMERIC = re.compile(r"\+?(?:[0-9][0-9_]*+(?::[0-9]++)*+\.?[0-9_]*+(?:[eE].*)?|0[bx].*|\.[0-9iInN].*|[0-9]{4}-[0-9].*)")
_WORDS = frozenset("y n yes no true false on off null".split())
_DEEPEST = 30
_ODD = object()


def _scalar(text: str):
    """A plain scalar's value; ``_ODD`` if the loader may read it as more than text, a plain integer or true and false."""
    if text[0].isalpha():
        return text if text.lower() not in _WORDS else text == "true" if text == "true" or text == "false" else _ODD
    if text.isdigit() and len(text) < 19 and (text[0] != "0" or text == "0"):
        return int(text)
    return _ODD if _NUMERIC.fullmatch(text) else text


def _read_plain(text: str) -> dict | None:
    """The mapping that a plain block document holds, as the loader would build it; None for any text that has something else in it (anchors, tags, block and
    multi-line scalars, escapes, flow mappings, several documents, other numbers, mistakes), which is the loader's to read."""
    lines = _LINE.findall(text)
    if len(lines) <= text.count("\n"):
        return None
    root: dict | None = None
    outer: list = []             # (column, mapping or list) around the innermost open one, outermost first
    column, node = 0, None       # the innermost
    waits = None                 # its last key if the value may follow on the next lines
    for indent, dash, key, plain, other in lines:
        if plain:
            value = _scalar(plain)
            if value is _ODD:
                return None
        elif not other:
            if not key:
                if dash:
                    return None
                continue         # blank or a comment
            value = None
        elif other[0] != "[":
            value = other[1:-1]
        else:
            items = [x.strip(" ") for x in other[1:-1].split(",")]
            value = [_scalar(x) if _ITEM.fullmatch(x) else _ODD for x in items] if items != [""] else []
            if _ODD in value:
                return None
        at = len(indent)
        if node is None:
            if dash:
                return None
            column, node = at, (root := {})
        elif waits is not None and (at > column or dash and at == column):
            outer.append((column, node))
            if len(outer) > _DEEPEST:
                return None
            below: dict | list = [] if dash else {}
            node[waits] = below
            column, node = at, below
        else:
            while column > at:
                if not outer:
                    return None
                column, node = outer.pop()
        if not dash and type(node) is list:      # a list may stand in the column of its key; the next key ends it
            column, node = outer.pop()
        if column != at or type(node) is not (list if dash else dict):
            return None
        if dash:
            if not key:
                node.append(value)
                waits = None
                continue
            outer.append((column, node))
            below = {}
            node.append(below)
            column, node = at + 2, below
        if not key or key.lower() in _WORDS:
            return None
        node[key] = value
        waits = key if value is None else None
    return root


def _load_mapping(text):
    """The document if it is a mapping. Whatever a loader raises on a model's output (bad syntax, impossible dates,
    too deep nesting) makes it no document. A plain document, the usual case, is read without the loader in a tenth of the time."""
    doc = _read_plain(text)
    if doc is not None:
        return doc
    import yaml  # gated: only this step needs it
    loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)   # libyaml when present
    try:
        doc = yaml.load(text, Loader=loader)
    except (yaml.YAMLError, ValueError, RecursionError, TypeError, OverflowError, AttributeError, KeyError):
        return None
    return doc if isinstance(doc, dict) else None


def parse_config(text: str | None) -> tuple[str, dict | None]:
    """(status, document). ``minor``: a mapping only after dropping code-fence
    lines and turning tabs into spaces."""
    if text is None:
        return "unparseable", None
    doc = _load_mapping(text)
    if doc is not None:
        return "valid", doc
    cleaned = "\n".join(line for line in text.replace("\t", "  ").split("\n")
                        if not line.lstrip().startswith("```"))
    doc = _load_mapping(cleaned) if cleaned != text else None
    return ("minor", doc) if doc is not None else ("unparseable", None)


def _keyed_schema(df: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    return [df.schema[k] for k in keys]


def flatten_yaml(df: DataFrame, id_col: str | Sequence[str] = "sample_id", text_col: str = "submission") -> DataFrame:
    """One row per YAML node: (id columns, status, path, value, vtype); root
    path is ``''``, list items ``a[0].b``, dots in keys escaped; an unparseable document gives one
    row with NULL path. Id columns of any type pass through unchanged. Runs per partition on Arrow batches."""
    import pyarrow as pa
    keys = [id_col] if isinstance(id_col, str) else list(id_col)
    names = ("status", "path", "value", "vtype")
    schema = T.StructType(_keyed_schema(df, keys) + [T.StructField(n, T.StringType()) for n in names])

    def run(batches):
        for b in batches:
            owner, rows = [], []
            for i, text in enumerate(b.column(len(keys)).to_pylist()):
                status, doc = parse_config(text)
                found = [(None, None, None)] if doc is None else _walk(doc)
                owner += [i] * len(found)
                rows += [(status, *n) for n in found]
            at = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(at) for c in range(len(keys))), *(pa.array([r[c] for r in rows], pa.string()) for c in range(4))],
                                             names=[*keys, *names])

    return df.select(*keys, F.col(text_col).alias("_text")).mapInArrow(run, schema)


# ---- node maps (scoring path) ---------------------------------------------------------

def node_maps(df: DataFrame, text_cols: dict[str, str], paths: Sequence[str], keep_text: bool = True) -> DataFrame:
    """Adds ``<side>_status`` and ``<side>_nodes`` (map path -> struct(value,
    vtype)) for each YAML text column, parsed once per row inside the scan's
    stage: no shuffle, and only the requested paths are looked up. The other columns, of any type, pass
    through the Python workers as Arrow sent them. With
    ``keep_text=False`` the texts are not sent back (most of the step's volume when nothing downstream reads them)."""
    import pyarrow as pa
    texts = set(text_cols.values())
    kept = [f for f in df.schema.fields if keep_text or f.name not in texts]
    fields = list(kept)
    for side in text_cols:
        fields += [T.StructField(f"{side}_status", T.StringType()), *(T.StructField(f"{side}_{c}", T.ArrayType(T.StringType())) for c in ("paths", "values", "vtypes"))]
    at = {c: df.columns.index(c) for c in df.columns}
    wanted = _tree(paths)

    def run(batches):
        for b in batches:
            columns = [b.column(at[f.name]) for f in kept]
            for col in text_cols.values():
                status, ends, flat = [], [0], ([], [], [])
                last: tuple = (None, None)
                for text in b.column(at[col]).to_pylist():
                    if text is None or text != last[0]:  # neighbours often share a reference
                        state, doc = parse_config(text)
                        last = text, (state, [] if doc is None else _take(doc, wanted))
                    status.append(last[1][0])
                    for _, path, value, vtype in last[1][1]:
                        flat[0].append(path)
                        flat[1].append(value)
                        flat[2].append(vtype)
                    ends.append(len(flat[0]))
                offsets = pa.array(ends, pa.int32())
                columns += [pa.array(status, pa.string()), *(pa.ListArray.from_arrays(offsets, pa.array(c, pa.string())) for c in flat)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    out = df.mapInArrow(run, T.StructType(fields))
    for side in text_cols:
        nodes = F.map_from_arrays(F.col(f"{side}_paths"),
                                  F.arrays_zip(F.col(f"{side}_values").alias("value"),
                                               F.col(f"{side}_vtypes").alias("vtype")))
        out = out.withColumn(f"{side}_nodes", nodes).drop(f"{side}_paths", f"{side}_values", f"{side}_vtypes")
    return out


@dataclass
class Doc:
    """Node lookups on the submission (``s``) and reference (``t``) maps."""

    def _n(self, side: str, p: str) -> Column:
        return F.col(f"{side}_nodes")[p]

    def sv(self, p):
        return self._n("s", p)["value"]

    def st(self, p):
        return self._n("s", p)["vtype"]

    def tv(self, p):
        return self._n("t", p)["value"]

    def tt(self, p):
        return self._n("t", p)["vtype"]

    def has(self, p) -> Column:
        return self.st(p).isNotNull()

    def match(self, p) -> Column:
        return F.coalesce(self.sv(p) == self.tv(p), F.lit(False))


# ---- criterion helpers --------------------------------------------------------------

def count_true(*conds: Column) -> Column:
    out = F.lit(0)
    for c in conds:
        out = out + F.coalesce(c, F.lit(False)).cast("int")
    return out


def band(n: Column, for5: int, for3: int) -> Column:
    return F.when(n >= for5, F.lit(5)).when(n >= for3, F.lit(3)).otherwise(F.lit(1))


def parsability(status: Column) -> Column:
    return F.when(status == "valid", F.lit(5)).when(status == "minor", F.lit(3)).otherwise(F.lit(1))


def type_errors(d: Doc, leaves: Sequence[str]) -> Column:
    """Expected leaves present on both sides with different node types."""
    n = count_true(*[d.has(p) & (d.st(p) != d.tt(p)) for p in leaves])
    return F.when(n == 0, F.lit(5)).when(n <= 2, F.lit(3)).otherwise(F.lit(1))


def near_port(v: Column, vt: Column, want: int) -> Column:
    port = F.when(vt == "int", v.try_cast("bigint"))
    return F.when(port == want, F.lit(5)).when(port.between(want - 2, want + 2), F.lit(3)).otherwise(F.lit(1))


@dataclass
class Rubric:
    key: str
    title: str
    max_points: int
    paths: list[str]
    criteria: list[tuple[str, str]] = field(default_factory=list)   # (id, description)


# ---- fixed values: rubric criteria (keys, expected constants, bands) ----
SLICE_ROOT = ["apiVersion", "kind", "metadata", "spec"]
SLICE_SPEC = ["spec.sst", "spec.sd", "spec.uplink_throughput", "spec.downlink_throughput", "spec.max_latency",
              "spec.ue_density"]
SLICE_LEAVES = ["apiVersion", "kind", "metadata.name", "metadata.labels.region"] + SLICE_SPEC
SLICE_TYPES = {"eMBB": 1, "URLLC": 2, "mMTC": 3, "V2X": 4}

AMF_ROOT = ["amf", "nrf"]
AMF_NESTED = ["amf.sbi", "amf.ngap", "amf.guami", "amf.tai", "amf.plmn_support", "amf.security", "nrf.sbi"]
AMF_SBI_ADDRESS, AMF_SBI_PORT, AMF_NGAP_PORT, NRF_SBI_PORT = "127.0.0.6", 7777, 38412, 7777
AMF_INTEGRITY_ORDER = ["NIA2", "NIA1", "NIA0"]
AMF_CIPHERING_ORDER = ["NEA2", "NEA1", "NEA0"]
AMF_PLMN = ["amf.guami[0].plmn_id", "amf.tai[0].plmn_id", "amf.plmn_support[0].plmn_id"]
AMF_ADDRESSES = ["amf.ngap.server[0].address", "nrf.sbi.server[0].address"]
AMF_LEAVES = (["amf.sbi.server[0].address", "amf.sbi.server[0].port", "amf.ngap.server[0].address",
               "amf.ngap.server[0].port", "amf.tai[0].tac", "amf.security.integrity_order",
               "amf.security.ciphering_order", "nrf.sbi.server[0].address", "nrf.sbi.server[0].port"]
              + [f"{p}.{k}" for p in AMF_PLMN for k in ("mcc", "mnc")])

SUB_ROOT = ["imsi", "msisdn", "security", "subscribed_rau_tau_timer", "network_access_mode", "subscriber_status",
            "access_restriction_data", "slice"]
SUB_NESTED = ["security.k", "security.opc", "security.amf", "slice[0].sst", "slice[0].sd",
              "slice[0].default_indicator"]
SUB_FIXED = ["subscribed_rau_tau_timer", "network_access_mode", "subscriber_status", "access_restriction_data"]
SUB_NUMERIC_STRINGS = ["imsi", "msisdn", "slice[0].sd"]
SUB_LEAVES = ["imsi", "msisdn"] + SUB_NESTED + SUB_FIXED
# ---- end of fixed values ----

SLICE = Rubric("slice_deployment", "Network slice YAML", 80, sorted(set(SLICE_ROOT + SLICE_LEAVES)), [
    ("S1", "YAML parses (valid 5, minor errors 3, unparseable 1)"),
    ("S2", "root keys apiVersion, kind, metadata, spec (all 5, two or three 3)"),
    ("S3", "spec keys sst, sd, uplink_throughput, downlink_throughput, max_latency, ue_density (all 5, four or five 3)"),
    ("S4", "node types equal the reference (no error 5, one or two 3)"),
    ("G1", "apiVersion and kind equal the reference (both 5, one 3)"),
    ("G2", "sst and sd equal the reference"), ("G3", "both throughputs equal the reference"),
    ("G4", "max_latency and ue_density equal the reference"), ("G5", "metadata name and labels.region equal the reference"),
    ("T1", "sst is the requested slice type 5, another type 1-4 3"),
    ("T2", "sd is the requested one 5, equal up to case and leading zeros 3"),
    ("T3", "region is the requested data centre 5, present 3"),
    ("F1", "both throughputs end in Mbps (both 5, one 3)"), ("F2", "latency ends in ms 5, another unit 3"),
    ("F3", "ue_density is high or low 5, in another case 3"), ("F4", "name is slice-{type}-{app} 5, starts slice- 3"),
])
AMF = Rubric("amf_configuration", "AMF configuration YAML", 55,
             sorted(set(AMF_ROOT + AMF_NESTED + AMF_LEAVES)), [
    ("S1", "YAML parses"), ("S2", "root keys amf and nrf (both 5, one 3)"),
    ("S3", "nested keys amf.{sbi, ngap, guami, tai, plmn_support, security} and nrf.sbi (all 5, four to six 3)"),
    ("S4", "node types equal the reference"),
    ("G1", "SBI address 127.0.0.6 and port 7777 (both 5, one 3)"),
    ("G2", "NGAP port 38412 5, within 2 3"), ("G3", "NRF SBI port 7777 5, within 2 3"),
    ("G4", "integrity and ciphering orders exact (both 5, one 3)"),
    ("G5", "TAC, MCC and MNC of the task (all 5, one or two 3)"),
    ("F1", "the six MCC/MNC values are quoted strings (all 5, three or more 3)"),
    ("F2", "the three PLMN ids agree; both addresses are 192.168.x.x (both 5, one 3)"),
])
SUBSCRIBER = Rubric("ue_provisioning", "Subscriber profile YAML", 55,
                    sorted(set(SUB_ROOT + SUB_LEAVES)), [
    ("S1", "YAML parses"), ("S2", "the eight root keys (all 5, five to seven 3)"),
    ("S3", "security.{k, opc, amf} and slice[0].{sst, sd, default_indicator} (all 5, four or five 3)"),
    ("S4", "node types equal the reference"),
    ("G1", "imsi and msisdn equal the reference (both 5, one 3)"),
    ("G2", "the three security values equal the reference (all 5, one or two 3)"),
    ("G3", "the three slice values equal the reference"),
    ("G4", "the four fixed settings equal the reference (all 5, two or three 3)"),
    ("G5", "IMSI and sd of the task (both 5, one 3)"),
    ("F1", "k and opc are 32 hex characters (both 5, one 3)"),
    ("F2", "numeric strings quoted: none unquoted 5, one 3"),
])
RUBRICS = {r.key: r for r in (SLICE, AMF, SUBSCRIBER)}


def rubric_text(key: str) -> str:
    """The rubric text that a grader reads: the fixed file of the category."""
    return files("evalframe").joinpath("rubrics", f"{key}.txt").read_text(encoding="utf-8")


def rubric_table(spark: SparkSession) -> DataFrame:
    """The rubric dimension: one row per category key."""
    rows = ", ".join(f"(:key{i}, :text{i})" for i in range(len(RUBRICS)))  # literal rows: the planner knows their size and broadcasts them
    values = {f"key{i}": k for i, k in enumerate(RUBRICS)} | {f"text{i}": rubric_text(k) for i, k in enumerate(RUBRICS)}
    return spark.sql(f"select * from values {rows} as t(category_key, rubric)", args=values)


# ---- criteria ---------------------------------------------------------------------------

def _slice(d: Doc, task: dict[str, Column]) -> list[Column]:
    sst, sd = "spec.sst", "spec.sd"
    up, down = "spec.uplink_throughput", "spec.downlink_throughput"
    lat, dens = "spec.max_latency", "spec.ue_density"
    name, region = "metadata.name", "metadata.labels.region"
    strip0 = lambda c: F.lower(F.regexp_replace(c, "^0+", ""))
    return [
        parsability(F.col("s_status")),
        band(count_true(*[d.has(p) for p in SLICE_ROOT]), 4, 2),
        band(count_true(*[d.has(p) for p in SLICE_SPEC]), 6, 4),
        type_errors(d, SLICE_LEAVES),
        band(count_true(d.match("apiVersion"), d.match("kind")), 2, 1),
        band(count_true(d.match(sst), d.match(sd)), 2, 1),
        band(count_true(d.match(up), d.match(down)), 2, 1),
        band(count_true(d.match(lat), d.match(dens)), 2, 1),
        band(count_true(d.match(name), d.match(region)), 2, 1),
        F.when((d.st(sst) == "int") & (d.sv(sst) == task["sst"].cast("string")), F.lit(5))
         .when((d.st(sst) == "int") & d.sv(sst).isin(*[str(v) for v in SLICE_TYPES.values()]), F.lit(3))
         .otherwise(F.lit(1)),
        F.when(d.sv(sd) == task["sd"], F.lit(5)).when(strip0(d.sv(sd)) == strip0(task["sd"]), F.lit(3))
         .otherwise(F.lit(1)),
        F.when(d.sv(region) == task["region"], F.lit(5)).when(d.has(region), F.lit(3)).otherwise(F.lit(1)),
        band(count_true((d.st(up) == "str") & d.sv(up).endswith("Mbps"),
                        (d.st(down) == "str") & d.sv(down).endswith("Mbps")), 2, 1),
        F.when((d.st(lat) == "str") & d.sv(lat).endswith("ms"), F.lit(5))
         .when(d.sv(lat).rlike(r"^\s*[0-9]+(\.[0-9]+)?\s*[A-Za-z]+\s*$"), F.lit(3)).otherwise(F.lit(1)),
        F.when(d.sv(dens).isin("high", "low"), F.lit(5)).when(F.lower(d.sv(dens)).isin("high", "low"), F.lit(3))
         .otherwise(F.lit(1)),
        F.when(d.sv(name).rlike(r"^slice-[a-z]+-.+"), F.lit(5)).when(d.sv(name).startswith("slice-"), F.lit(3))
         .otherwise(F.lit(1)),
    ]


def _amf(d: Doc, task: dict[str, Column]) -> list[Column]:
    mcc = [f"{p}.mcc" for p in AMF_PLMN]
    mnc = [f"{p}.mnc" for p in AMF_PLMN]
    all_eq = lambda ps, want: F.coalesce(
        F.reduce(F.array(*[d.sv(p) == want for p in ps]), F.lit(True), lambda a, b: a & b), F.lit(False))
    plmn_agree = count_true(*[(d.sv(mcc[i]) == d.sv(mcc[0])) & (d.sv(mnc[i]) == d.sv(mnc[0])) for i in (1, 2)]) == 2
    addr_ok = count_true(*[d.sv(p).rlike(r"^192\.168\.[0-9]{1,3}\.[0-9]{1,3}$") for p in AMF_ADDRESSES]) == 2
    return [
        parsability(F.col("s_status")),
        band(count_true(*[d.has(p) for p in AMF_ROOT]), 2, 1),
        band(count_true(*[d.has(p) for p in AMF_NESTED]), 7, 4),
        type_errors(d, AMF_LEAVES),
        band(count_true(d.sv("amf.sbi.server[0].address") == AMF_SBI_ADDRESS,
                        (d.st("amf.sbi.server[0].port") == "int")
                        & (d.sv("amf.sbi.server[0].port") == str(AMF_SBI_PORT))), 2, 1),
        near_port(d.sv("amf.ngap.server[0].port"), d.st("amf.ngap.server[0].port"), AMF_NGAP_PORT),
        near_port(d.sv("nrf.sbi.server[0].port"), d.st("nrf.sbi.server[0].port"), NRF_SBI_PORT),
        band(count_true(d.sv("amf.security.integrity_order") == json.dumps(AMF_INTEGRITY_ORDER),
                        d.sv("amf.security.ciphering_order") == json.dumps(AMF_CIPHERING_ORDER)), 2, 1),
        band(count_true(d.sv("amf.tai[0].tac") == task["tac"].cast("string"), all_eq(mcc, task["mcc"]),
                        all_eq(mnc, task["mnc"])), 3, 1),
        band(count_true(*[d.st(p) == "str" for p in mcc + mnc]), 6, 3),
        band(count_true(plmn_agree, addr_ok), 2, 1),
    ]


def _subscriber(d: Doc, task: dict[str, Column]) -> list[Column]:
    hex32 = r"^[0-9A-Fa-f]{32}$"
    unquoted = count_true(*[d.st(p).isin("int", "float") for p in SUB_NUMERIC_STRINGS])
    return [
        parsability(F.col("s_status")),
        band(count_true(*[d.has(p) for p in SUB_ROOT]), 8, 5),
        band(count_true(*[d.has(p) for p in SUB_NESTED]), 6, 4),
        type_errors(d, SUB_LEAVES),
        band(count_true(d.match("imsi"), d.match("msisdn")), 2, 1),
        band(count_true(*[d.match(f"security.{k}") for k in ("k", "opc", "amf")]), 3, 1),
        band(count_true(*[d.match(f"slice[0].{k}") for k in ("sst", "sd", "default_indicator")]), 3, 1),
        band(count_true(*[d.match(p) for p in SUB_FIXED]), 4, 2),
        band(count_true(d.sv("imsi") == task["imsi"], d.sv("slice[0].sd") == task["sd"]), 2, 1),
        band(count_true(d.sv("security.k").rlike(hex32), d.sv("security.opc").rlike(hex32)), 2, 1),
        F.when(unquoted == 0, F.lit(5)).when(unquoted == 1, F.lit(3)).otherwise(F.lit(1)),
    ]


_CRITERIA = {"slice_deployment": _slice, "amf_configuration": _amf, "ue_provisioning": _subscriber}


def score_rubric(rubric_key: str, configs: DataFrame, task_cols: dict[str, str], id_col: str | Sequence[str] = "sample_id",
                 submission_col: str = "submission", reference_col: str = "reference",
                 references: DataFrame | None = None, reference_key: str = "sample_id") -> DataFrame:
    """Score each submission against its reference config and task values.

    ``id_col`` names one or more key columns of any type, such as (model, sample_id, epoch). ``task_cols`` maps the rubric's task inputs
    (slice: sst, sd, region; AMF: tac, mcc, mnc; subscriber: imsi, sd) to columns of ``configs``.
    Returns the keys, status, one column per criterion, total and score.

    The reference is a column of ``configs``, parsed in the same row (one narrow stage), or, where models and epochs give a sample many
    submissions, a row of ``references`` (``reference_key``, ``reference_col``): each is then parsed once and its few nodes are joined."""
    r = RUBRICS[rubric_key]
    keys = [id_col] if isinstance(id_col, str) else list(id_col)
    task = [F.col(c).alias(f"task_{k}") for k, c in task_cols.items()]
    if references is None:
        docs = node_maps(configs.select(*keys, submission_col, reference_col, *task), {"s": submission_col, "t": reference_col}, r.paths, keep_text=False)
    else:
        own = list(dict.fromkeys([*keys, reference_key]))
        docs = node_maps(configs.select(*own, submission_col, *task), {"s": submission_col}, r.paths, keep_text=False)
        truth = node_maps(references.select(reference_key, reference_col), {"t": reference_col}, r.paths, keep_text=False)
        docs = docs.join(truth, reference_key)
    d = Doc()
    crit = _CRITERIA[rubric_key](d, {k: F.col(f"task_{k}") for k in task_cols})
    unparsed = F.col("s_status") == "unparseable"
    named = [F.when(unparsed, F.lit(1)).otherwise(c).alias(cid) for c, (cid, _) in zip(crit, r.criteria)]
    out = docs.select(*keys, F.col("s_status").alias("status"), *named)
    total = sum((F.col(cid) for cid, _ in r.criteria), F.lit(0))
    return out.withColumn("total", total.cast("int")) \
        .withColumn("score", F.col("total") * F.lit(100.0) / F.lit(r.max_points))

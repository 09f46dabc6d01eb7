"""Equivalent DuckDB SQL for the registered queries (the correctness oracle).

Same semantics as the Spark plans, written independently in SQL over the
driver's tables. Doubles that feed comparisons are written as
``<value>::DOUBLE`` so no DECIMAL arithmetic creeps in.
"""

from __future__ import annotations

import re

# Everything below is written out here, independently of the engine's modules.
# Numeric text, the catalog record, and the map projection
# (WGS 84: a = 6378137, f = 1/298.257223563; UTM zone 38N).
INTEGER_TEXT = r"^[+-]?[0-9]+$"
FLOAT_TEXT = r"^[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)$"
FLOAT_TAIL = r"[fFdD]$"
RECORD = (("satellite", "VARCHAR"), ("data_url", "VARCHAR"), ("level", "VARCHAR"), ("load_info", "VARCHAR"),
          ("resolution", "VARCHAR"), ("image_url", "VARCHAR"), ("timestamp", "BIGINT"), ("image_id", "VARCHAR"),
          ("provider", "VARCHAR"), ("name_en", "VARCHAR"), ("band_count", "INTEGER"), ("sensor", "VARCHAR"),
          ("boundary", "VARCHAR"), ("cloud", "DOUBLE"))
UTM = {"a": "6378137.0", "e2": "0.0066943799901413165", "deg": "(pi() / 180)", "lon0": "45.0", "k0": "0.9996",
       "fe": "500000.0", "fn": "0.0"}


def _d(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


# ---- derived inputs ----------------------------------------------------------

LINES = """lines as (
  select o_orderkey as line_id, concat(
    '"SAT,', o_orderstatus, '",http://x/', cast(o_orderkey as varchar), ',L1,', o_orderpriority,
    ',15m,http://x/i/', cast(o_orderkey as varchar), ',',
    case when o_orderkey % 53 = 0 then '' else cast(o_orderkey * 1000 as varchar) end,
    ',img', cast(o_custkey as varchar), ',p,name,',
    case when o_orderkey % 89 = 0 then 'n/a' when o_orderkey % 31 = 0 then ''
         else cast(o_orderkey % 14 as varchar) end,
    ',VNIR,"', cast(o_custkey as varchar), ' ', cast(o_orderkey as varchar), ',',
    cast(o_custkey + 1 as varchar), ' ', cast(o_orderkey as varchar), '"',
    case when o_orderkey % 97 = 0 then ''
         else concat(',', case when o_orderkey % 41 = 0 then '' else cast(o_orderkey % 100 as varchar) end) end
  ) as line
  from orders)"""

# second copies: identical lines, and lines with another level; a tenth of the customers share an image
KEYED = """keyed0 as (select l.line_id, case when o.o_custkey % 10 = 0 then
    regexp_replace(l.line, ',img[0-9]+,', ',imgHOT,', 'g') else l.line end as line
  from lines l join orders o on l.line_id = o.o_orderkey),
keyed1 as (select line_id, line from keyed0
  union all select line_id, line from keyed0 where line_id % 7 = 0
  union all select line_id, replace(line, ',L1,', ',L2,') from keyed0 where line_id % 11 = 0),
keyed as (select *, row_number() over () as rid from keyed1)"""

LINES_L = """lines_l as (
  select event_id, concat(cast(event_id as varchar), ',"', event_type, ',', cast(user_id as varchar), '",',
                          props, ',', cast(value as varchar)) as l
  from events)"""

OBS = """obs as (
  select l_linenumber as scene, l_partkey * 500.0::DOUBLE + 250 as x, l_suppkey * 500.0::DOUBLE + 250 as y,
         l_shipdate as acq, l_orderkey, 1 + l_tax as b2, 1 + l_discount as b3,
         l_extendedprice / 1000 as b4, l_quantity as b6
  from lineitem)"""

NODATA = OBS.replace("obs as", "obs0 as") + """,
obs as (select * replace (case when l_orderkey % 97 = 0 then null when l_orderkey % 101 = 0 then 'NaN'::DOUBLE
                               when l_orderkey % 103 = 0 then -b4 else b6 end as b6) from obs0)"""

GEO = """geo as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey,
         42 + (l_partkey % 600) / 100.0::DOUBLE as lon, (l_suppkey % 85) - 20.0::DOUBLE as lat
  from lineitem)"""

VNIR = """vnir as (
  select l_linenumber as scene, l_partkey as x, l_suppkey as y, max(l_shipdate) as acq,
         cast(sum(l_quantity) as bigint) as b2,
         cast(sum(round(l_discount * 100)) as bigint) as b3
  from lineitem group by 1, 2, 3)"""

SWIR = """swir as (
  select l_linenumber as scene, cast(floor(l_partkey / 2.0::DOUBLE) as bigint) as px,
         cast(floor(l_suppkey / 2.0::DOUBLE) as bigint) as py, cast(sum(round(l_extendedprice)) as bigint) as b4,
         cast(sum(l_quantity) as bigint) as b6
  from lineitem group by 1, 2, 3)"""

BLOCKS = """blocks as (select scene, cast(floor(x / 2.0::DOUBLE) as bigint) as px, cast(floor(y / 2.0::DOUBLE) as bigint) as py,
                  avg(b2) as b2, avg(b3) as b3, count(*) as n, max(acq) as acq from vnir group by 1, 2, 3)"""

EXTENTS = """extents as (
  select l_linenumber as scene,
         case l_linenumber when 2 then concat(min(l_partkey), ' bad ', min(l_suppkey), ' ', max(l_suppkey))
           when 4 then concat(min(l_partkey), '  ', max(l_partkey), ' ', min(l_suppkey), ' ', max(l_suppkey))
           when 5 then concat(min(l_partkey), ' ', max(l_partkey), ' ', min(l_suppkey))
           when 6 then concat(min(l_partkey), '.25 ', max(l_partkey), ' ', min(l_suppkey), ' ', max(l_suppkey))
           else concat(min(l_partkey), ' ', max(l_partkey), ' ', min(l_suppkey), ' ', max(l_suppkey)) end as plain,
         concat(min(l_partkey), ' ', max(l_partkey), ' ', max(l_suppkey), ' ', min(l_suppkey)) as shell
  from lineitem group by 1)"""

TOKENS = """tokens as (
  select event_id, concat('f', cast(event_id as varchar), '.TIF note.txt ', event_type, '.TIF g',
                          cast(user_id as varchar), '.tif h.TIF') as txt
  from events)"""

PAGE_NAMES = """page_names as (
  select page_id, url, regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1) as name
  from pages)"""


TILES = """tiles as (
  select vec_id, label as scene, (vec_id % 16) * 4000.0::DOUBLE as tile_minx,
         400000.0::DOUBLE - floor(vec_id / 16) * 4000.0::DOUBLE as tile_maxy, embedding as value
  from embeddings)"""


def split_cte(name: str, src: str, text: str) -> str:
    """Quote-aware comma split (``p``): a comma splits when an even number of
    double quotes follows it to the end of the text."""
    return f"""{name}_k as (
  select *, list_filter(range(1, length({text}) + 1), lambda i: {text}[i] = ','
           and (length({text}[i+1:]) - length(replace({text}[i+1:], '"', ''))) % 2 = 0) as _k
  from {src}),
{name}_e as (select *, list_concat([0], _k, [length({text}) + 1]) as _e from {name}_k),
{name} as (select * exclude (_k, _e),
  list_transform(range(1, len(_e)), lambda j: {text}[_e[j] + 1 : _e[j + 1] - 1]) as p from {name}_e)"""


def _nz(t: str) -> str:
    return f"(case when {t} is null or {t} = '' then '0' else {t} end)"


def _jtrim(t: str) -> str:
    return f"regexp_replace({t}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def _parse(t: str, kind: str) -> tuple[str, bool]:
    """(value SQL, is_numeric) of one field's raw text."""
    if kind in ("BIGINT", "INTEGER"):
        s = _nz(t)
        return f"(case when regexp_matches({s}, '{INTEGER_TEXT}') then try_cast({s} as {kind}) end)", True
    if kind == "DOUBLE":
        s = _jtrim(_nz(t))
        return (f"(case when regexp_matches({s}, '{FLOAT_TEXT}') "
                f"then try_cast(regexp_replace({s}, '{FLOAT_TAIL}', '') as double) end)"), True
    return t, False


def decode_ctes(src: str, text: str, keep: str) -> str:
    """CTEs ending in ``dec``: keep columns, typed fields, error, error_field, _text."""
    n = len(RECORD)
    vals, gates, bad = [], [], []
    for i, (name, kind) in enumerate(RECORD, start=1):
        v, numeric = _parse(f"p[{i}]", kind)
        vals.append(f"{v} as _v{i}")
        if numeric:
            vals.append(f"(_v{i} is not null) as _ok{i}")
            gates.append(f"_ok{i}")
            bad.append(f"case when not _ok{i} then '{name}' end")
    outs = []
    for i, (name, kind) in enumerate(RECORD, start=1):
        upto = ["_arity"] + [g for g in gates if int(g[3:]) <= i]
        outs.append(f"cast(case when {' and '.join(upto)} then _v{i} "
                    f"else {'NULL' if kind == 'VARCHAR' else '0'} end as {kind}) as {name}")
    first_bad = f"coalesce({', '.join(bad)})" if bad else "NULL"
    dv_cols = ",\n         ".join(vals)
    return f"""{split_cte('dsp', src, text)},
dv0 as (select {keep}, {text} as _text, p, len(p) = {n} as _arity from dsp),
dv as (select *, {dv_cols} from dv0),
dec as (select {keep}, _text, {', '.join(outs)},
  case when not _arity then 'arity' when {first_bad} is not null then 'type' end as error,
  case when _arity then {first_bad} end as error_field
  from dv)"""


FIELDS = ", ".join(name for name, _ in RECORD)
STORED = FIELDS + ", 'ADMIN' as owner, 'PUBLIC' as privilege, false as has_data"

# ---- grid over the obs pixels ---------------------------------------------------

RES, W, H = 500.0, 250, 200


def grid_ctes(index_sql: str, mask_sql: str, obs: str = NODATA, pixel: float = RES) -> str:
    """obs -> scene extents (se) -> union (ext) -> shape -> index pixels (ip) -> placed (pl)."""
    return f"""{obs},
se as (select scene, min(x) - {_d(pixel / 2)} as minx, max(x) + {_d(pixel / 2)} as maxx,
              min(y) - {_d(pixel / 2)} as miny, max(y) + {_d(pixel / 2)} as maxy
       from obs where x is not null and y is not null and not isnan(x) and not isnan(y) group by scene),
ext as (select min(minx) as minx, max(maxx) as maxx, min(miny) as miny, max(maxy) as maxy from se
        where minx is not null and maxx is not null and miny is not null and maxy is not null
          and not isnan(minx) and not isnan(maxx) and not isnan(miny) and not isnan(maxy)),
shape as (select *, greatest(1, cast(ceil((maxx - minx) / {_d(RES)}) as int)) as ncx,
                    greatest(1, cast(ceil((maxy - miny) / {_d(RES)}) as int)) as ncy,
                    greatest(1, cast(ceil((maxx - minx) / {_d(RES * W)}) as int)) as nfc,
                    greatest(1, cast(ceil((maxy - miny) / {_d(RES * H)}) as int)) as nfr from ext),
ip as (select *, case when not isnan({index_sql}) then {index_sql} end as v from obs where {mask_sql}),
pl as (select ip.*, least(cast(floor((x - s.minx) / {_d(RES)}) as int), s.ncx - 1) as gx,
              least(cast(floor((s.maxy - y) / {_d(RES)}) as int), s.ncy - 1) as gy
       from ip cross join shape s
       where x >= s.minx and x <= s.maxx and y >= s.miny and y <= s.maxy)"""


def cells_sql(agg: str) -> str:
    return f"""m0 as (select gx, gy, {agg} as v, count(*) as n from pl where v is not null group by gx, gy),
m as (select gx, gy, cast(floor(gy / {H}) as int) as frame_row, cast(floor(gx / {W}) as int) as frame_col, v, n from m0),
mosaic as (select gx, gy, frame_row, frame_col, gy - frame_row * {H} as cell_row, gx - frame_col * {W} as cell_col, v, n from m)"""


ARGILLIC = "(b4 - b6) / nullif(b4 + b6, 0)"
VEG_MASK = f"b3 / nullif(b2, 0) <= {_d(1.35)}"
LATEST = "max_by(v, row(acq, l_orderkey, scene, v))"


def _bit(thr: float) -> str:
    return f"cast(case when v is null then null when v >= {_d(thr)} then 1 else 0 end as int)"


def obs_map(agg: str = LATEST, index_sql: str = ARGILLIC, mask_sql: str = VEG_MASK, thr: float = 0.3,
            obs: str = NODATA) -> str:
    return f"""with {grid_ctes(index_sql, mask_sql, obs)},
{cells_sql(agg)},
bin as (select *, {_bit(thr)} as bit from mosaic)"""


SUMMARY = """select frame_row, frame_col, count(*) as n_cells, cast(sum(bit) as bigint) as hot_cells,
       max(v) as max_v from bin group by frame_row, frame_col"""

FRAMES = f"""fc as (select *, unnest(range(0, nfc)) as c from shape),
fr as (select *, unnest(range(0, nfr)) as r from fc),
frames as (select cast(r as int) as frame_row, cast(c as int) as frame_col,
                  concat('r', cast(r as varchar), '_c', cast(c as varchar)) as name,
                  minx + cast(c as int) * {_d(RES * W)} as minx, minx + (cast(c as int) + 1) * {_d(RES * W)} as maxx,
                  maxy - (cast(r as int) + 1) * {_d(RES * H)} as miny, maxy - cast(r as int) * {_d(RES * H)} as maxy
           from fr)"""


def _utm_constants(lon0: str) -> dict[str, str]:
    """The series' coefficients, from the eccentricity alone."""
    c = {k: f"({v})::DOUBLE" for k, v in (UTM | {"lon0": lon0}).items()}
    e = UTM["e2"] + "::DOUBLE"
    c["ep"] = f"({e} / (1 - {e}))"
    c["m1"] = f"(1 - {e} / 4 - 3 * pow({e}, 2) / 64 - 5 * pow({e}, 3) / 256)"
    c["m2"] = f"(3 * {e} / 8 + 3 * pow({e}, 2) / 32 + 45 * pow({e}, 3) / 1024)"
    c["m3"] = f"(15 * pow({e}, 2) / 256 + 45 * pow({e}, 3) / 1024)"
    c["m4"] = f"(35 * pow({e}, 3) / 3072)"
    return c


def utm_ctes(src: str, lon0: str = UTM["lon0"], digits: int = 3) -> str:
    """``g8``: the rows of ``src`` (lon, lat) with easting and northing, by default to the millimetre."""
    c = _utm_constants(lon0)
    return f"""g1 as (select *, lat * {c['deg']} as ph, (lon - {c['lon0']}) * {c['deg']} as dl from {src}),
g2 as (select *, sin(ph) as sp, cos(ph) as cp, tan(ph) as tp from g1),
g3 as (select *, {c['a']} / sqrt(1.0::DOUBLE - {c['e2']} * sp * sp) as n, tp * tp as t, {c['ep']} * cp * cp as c,
              dl * cp as aa,
              {c['a']} * ((({c['m1']} * ph - {c['m2']} * sin(2.0::DOUBLE * ph)) + {c['m3']} * sin(4.0::DOUBLE * ph))
                          - {c['m4']} * sin(6.0::DOUBLE * ph)) as m from g2),
g4 as (select *, aa * aa as a2 from g3),
g5 as (select *, a2 * aa as a3 from g4),
g6 as (select *, a3 * aa as a4 from g5),
g7 as (select *, a4 * aa as a5 from g6),
g7a as (select *, a5 * aa as a6 from g7),
g8 as (select *,
  round({c['fe']} + {c['k0']} * n * ((aa + (((1.0::DOUBLE - t) + c) * a3) / 6.0::DOUBLE)
        + ((((5.0::DOUBLE - 18.0::DOUBLE * t) + t * t) + 72.0::DOUBLE * c) - 58.0::DOUBLE * {c['ep']}) * a5 / 120.0::DOUBLE), {digits}) as easting,
  round({c['fn']} + {c['k0']} * (m + n * tp * ((a2 / 2.0::DOUBLE
        + (((5.0::DOUBLE - t) + 9.0::DOUBLE * c) + 4.0::DOUBLE * c * c) * a4 / 24.0::DOUBLE)
        + ((((61.0::DOUBLE - 58.0::DOUBLE * t) + t * t) + 600.0::DOUBLE * c) - 330.0::DOUBLE * {c['ep']}) * a6 / 720.0::DOUBLE)), {digits}) as northing
  from g7a)"""


STRIPS = OBS.replace("obs as", "obs0 as") + """,
obs as (select * replace (cast(floor(x / 50000.0::DOUBLE) as int) as scene) from obs0)"""

GAP = NODATA.replace("obs as", "obs1 as") + """,
obs as (select * replace (case when x >= 50000 then x + 600000.0::DOUBLE else x end as x) from obs1)"""

FOOTPRINT = f"""with {grid_ctes(ARGILLIC, VEG_MASK, NODATA, 2.3 * RES)},
box as (select ip.*, greatest(0.0::DOUBLE, (x - 575.0::DOUBLE - s.minx) / {_d(RES)}) as l,
               least((s.maxx - s.minx) / {_d(RES)}, (x + 575.0::DOUBLE - s.minx) / {_d(RES)}) as r,
               greatest(0.0::DOUBLE, (s.maxy - y - 575.0::DOUBLE) / {_d(RES)}) as a,
               least((s.maxy - s.miny) / {_d(RES)}, (s.maxy - y + 575.0::DOUBLE) / {_d(RES)}) as b
        from ip cross join shape s where v is not null),
bx as (select *, unnest(range(cast(floor(l) as bigint), cast(ceil(r) as bigint))) as gx from box),
by_ as (select *, unnest(range(cast(floor(a) as bigint), cast(ceil(b) as bigint))) as gy from bx),
wt as (select *, (least(r, gx + 1) - greatest(l, gx)) * (least(b, gy + 1) - greatest(a, gy)) as w from by_),
m0 as (select cast(gx as int) as gx, cast(gy as int) as gy, sum(v * w) / sum(w) as v, count(*) as n from wt group by gx, gy),
m as (select gx, gy, cast(floor(gy / {H}) as int) as frame_row, cast(floor(gx / {W}) as int) as frame_col, v, n from m0)
select gx, gy, frame_row, frame_col, gy - frame_row * {H} as cell_row, gx - frame_col * {W} as cell_col, round(v, 9) as v, n from m"""

LONLAT = NODATA.replace("obs as", "obs1 as") + """,
geo as (select * exclude (x, y), 42 + (x % 60000) / 10000.0::DOUBLE as lon,
               (y % 85000) / 1000.0::DOUBLE - 20.0::DOUBLE as lat from obs1),
""" + utm_ctes("geo") + """,
obs as (select *, easting as x, northing as y from g8)"""

FROM_BANDS = f"""{VNIR}, {SWIR}, {BLOCKS},
obs as (select b.*, s.b4, s.b6, (b.px + 0.5::DOUBLE) * 500.0::DOUBLE as x, (b.py + 0.5::DOUBLE) * 500.0::DOUBLE as y
        from blocks b join swir s using (scene, px, py))"""

DENSE_SUMMARY = """, su as (select frame_row, frame_col, count(*) as n_cells, cast(sum(bit) as bigint) as hot_cells,
       max(v) as max_v from bin group by frame_row, frame_col)
select f.frame_row, f.frame_col, coalesce(n_cells, 0) as n_cells, coalesce(hot_cells, 0) as hot_cells, max_v
from frames f left join su on f.frame_row = su.frame_row and f.frame_col = su.frame_col"""


def _zones_sql() -> str:
    """Two zones: the same points under each central meridian, side by side."""
    def renamed(n: int, lon0: str) -> str:
        ctes = utm_ctes("geo", lon0, 9)
        for k in ("g7a", *[f"g{i}" for i in range(8, 0, -1)]):
            ctes = re.sub(rf"\b{k}\b", f"z{n}_{k}", ctes)
        return ctes

    return f"""with {GEO.replace("from lineitem", "from (select *, row_number() over () as rid from lineitem)").replace("select l_orderkey", "select rid, l_orderkey")},
{renamed(1, "45.0")}, {renamed(2, "51.0")}
select a.l_orderkey, a.l_linenumber, round(a.easting, 3) as e_38n, round(a.northing, 3) as n_38n,
       round(b.easting, 3) as e_39n, round(b.northing, 3) as n_39n,
       round(a.easting / 1000, 3) as e_38n_km, round(a.northing / 1000, 3) as n_38n_km
from z1_g8 a join z2_g8 b on a.rid = b.rid"""


def _extent_number(t: str) -> str:
    s = _jtrim(t)
    return (f"(case when regexp_matches({s}, '{FLOAT_TEXT}') "
            f"then try_cast(regexp_replace({s}, '{FLOAT_TAIL}', '') as double) end)")


def _extent_bad(col: str) -> str:
    parts = f"string_split({col}, ' ')"
    return (f"(case when {col} is null then 'missing' when len({parts}) <> 4 then 'arity' "
            f"when {' or '.join(_extent_number(f'{parts}[{i}]') + ' is null' for i in range(1, 5))} then 'number' end)")


def _parse_extent_sql(col: str, order: str, prefix: str) -> str:
    names = ("minx", "maxx", "miny", "maxy") if order == "plain" else ("minx", "maxx", "maxy", "miny")
    v = {nm: _extent_number(f"string_split({col}, ' ')[{i}]") for i, nm in enumerate(names, start=1)}
    out = []
    for lo, hi in (("minx", "maxx"), ("miny", "maxy")):
        for nm, op in ((lo, "<="), (hi, ">")):
            out.append(f"case when {_extent_bad(col)} is null then case when {v[lo]} {op} {v[hi]} "
                       f"then {v[lo]} else {v[hi]} end end as {prefix}{nm}")
    return ", ".join(out)


def _lines_split(keep: str = "line_id") -> str:
    return f"with {LINES},\n{split_cte('lsp', 'lines', 'line')}"


def _dec(keep: str = "line_id") -> str:
    return f"with {LINES},\n{decode_ctes('lines', 'line', keep)}"


def _nz_col(i: int) -> str:
    return _nz(f"p[{i}]")


def _char(t: str) -> str:
    return f"(case when {t} is null or {t} = '' then ' ' else substr({t}, 1, 1) end)"


def _trimq(t: str) -> str:
    return (f"(case when starts_with({t}, '\"') and ends_with({t}, '\"') and length({t}) >= 2 "
            f"then substr({t}, 2, length({t}) - 2) else {t} end)")


ORACLE: dict[str, str] = {
    "catalog_scan": f"with {LINES} select line as value from lines",
    "quoted_split": f"""with {LINES_L},
{split_cte('ssp', 'lines_l', 'l')}
select event_id, cast(unnest(range(1, len(p) + 1)) as int) as pos, unnest(p) as part from ssp""",
    "quoted_split_nonempty": f"""with {LINES_L},
{split_cte('ssp', 'lines_l', 'l')},
ne as (select event_id, list_filter(list_transform(p, lambda x: {_jtrim('x')}), lambda x: x <> '') as q from ssp)
select event_id, cast(unnest(range(1, len(q) + 1)) as int) as pos, unnest(q) as item from ne""",
    "typed_decode": f"{_dec()}\nselect line_id, {FIELDS} from dec",
    "empty_numeric_default": f"""{_lines_split()}
select line_id, {_nz_col(7)} as timestamp_text, {_nz_col(11)} as band_count_text, {_nz_col(14)} as cloud_text from lsp""",
    "char_decode": f"""{_lines_split()}
select line_id, {_char('p[1]')} as satellite_char, {_char('p[7]')} as timestamp_char from lsp""",
    "boolean_decode": """with f as (select doc_id, case when quality = 1 then 'True' when toxic = 1 then 'yes'
                                   else cast(quality as varchar) end as flag_text from labels)
select doc_id, flag_text, coalesce(lower(flag_text) = 'true', false) as flag from f""",
    "arity_check": f"""{_lines_split()}
select line_id, cast(len(p) as int) as n_parts, len(p) = 14 as arity_ok from lsp""",
    "decode_error_policy": f"{_dec()}\nselect line_id, error, error_field from dec",
    "record_encode": f"""{_dec()}
select line_id, concat_ws(',', {', '.join(f"coalesce(cast({name} as varchar), 'null')" for name, _ in RECORD)}) as record from dec""",
    "append_constants": f"{_dec()}\nselect line_id, {STORED} from dec",
    "has_length": f"""{_lines_split()}
select line_id, cast(len(p) as int) as n_parts,
       cast(len(list_filter(p, lambda x: x is not null and length(x) > 0)) as int) as n_with_length from lsp""",
    "trim_end": """select page_id, case when ends_with(url, '.html') then left(url, length(url) - 5) else url end as trimmed
from pages""",
    "trim_head": """select page_id, case when starts_with(url, 'https://') then substr(url, 9) else url end as trimmed
from pages""",
    "trim_quotechar": f"""{_lines_split()}
select line_id, {_trimq('p[1]')} as satellite, {_trimq('p[13]')} as boundary from lsp""",
    "output_path": f"""with {PAGE_NAMES},
sf as (select page_id, concat('AST_', cast(page_id as varchar), '_', name, '.hdf') as scene_file from page_names)
select page_id, scene_file, concat('/data/out/vnir/', replace(scene_file, '.hdf', '.tif')) as out_path from sf""",
    "token_list": f"""with {TOKENS},
tl as (select event_id, list_filter(regexp_split_to_array(txt, '\\s+'), lambda t: ends_with(t, '.TIF')) as q from tokens)
select event_id, cast(unnest(range(1, len(q) + 1)) as int) as pos, unnest(q) as token from tl""",
    "suffix_filter": f"with {PAGE_NAMES}\nselect page_id, url, name from page_names where ends_with(name, '.html')",
    "binary_threshold": f"{obs_map()}\nselect gx, gy, frame_row, frame_col, v, bit from bin",
    "tile_pixels": f"""with {TILES},
tp as (select vec_id, scene, tile_minx, tile_maxy, unnest(range(0, len(value))) as pos, unnest(value) as value
       from tiles)
select vec_id, scene, tile_minx + ((pos % 8) + 0.5::DOUBLE) * 500.0::DOUBLE as x,
       tile_maxy - (floor(pos / 8) + 0.5::DOUBLE) * 500.0::DOUBLE as y, value
from tp where pos < 64""",
    "tile_kernel": """with inner_px as (select list(y * 8 + x) as at from range(1, 7) a(y), range(1, 7) b(x)),
e as (select vec_id, list_transform(i.at, lambda p: abs(4 * embedding[p + 1]::double - embedding[p - 7]::double
             - embedding[p + 9]::double - embedding[p]::double - embedding[p + 2]::double)) as edges
      from embeddings, inner_px i where len(embedding) = 64)
select v.vec_id, round(list_max(edges), 6) as max_edge, round(list_avg(edges), 6) as mean_edge from embeddings v left join e using (vec_id)""",
    "export_vnir": f"with {OBS}\nselect scene, x, y, acq, l_orderkey, b2, b3 from obs",
    "export_swir": f"with {OBS}\nselect scene, x, y, acq, l_orderkey, b4, b6 from obs",
    "coregister": f"""with {VNIR}, {SWIR},
{BLOCKS}
select b.scene, b.px, b.py, b.acq, b.b2, b.b3, b.n, s.b4, s.b6 from blocks b join swir s using (scene, px, py)""",
    "argillic_index": f"with {NODATA}\nselect scene, x, y, acq, l_orderkey, case when not isnan({ARGILLIC}) then {ARGILLIC} end as v from obs where {VEG_MASK}",
    "project_utm": f"with {GEO}, {utm_ctes('geo')}\nselect l_orderkey, l_linenumber, lon, lat, easting, northing from g8",
    "scene_extent": f"{obs_map()}\nselect scene, minx, maxx, miny, maxy from se",
    "parse_extent": f"""with {EXTENTS}
select scene, {_parse_extent_sql('plain', 'plain', '')}, {_extent_bad('plain')} as error,
  {_parse_extent_sql('shell', 'shell', 's_')} from extents""",
    "extent_union": f"{obs_map()}\nselect minx, maxx, miny, maxy from ext",
    "extent_format": f"""with {EXTENTS},
pe as (select scene, {_parse_extent_sql('shell', 'shell', '')} from extents)
select scene,
  concat_ws(' ', cast(cast(minx as bigint) as varchar), cast(cast(maxx as bigint) as varchar),
                 cast(cast(miny as bigint) as varchar), cast(cast(maxy as bigint) as varchar)) as plain_text,
  concat_ws(' ', cast(cast(minx as bigint) as varchar), cast(cast(maxx as bigint) as varchar),
                 cast(cast(maxy as bigint) as varchar), cast(cast(miny as bigint) as varchar)) as shell_text
from pe""",
    "frame_grid": f"{obs_map()},\n{FRAMES}\nselect * from frames",
    "empty_frames": f"""{obs_map()},
{FRAMES},
cr as (select *, unnest(range(0, {H})) as cy from frames),
cc as (select *, unnest(range(0, {W})) as cx from cr)
select frame_row, frame_col, cast(cy as int) as cell_row, cast(cx as int) as cell_col,
       minx + (cast(cx as int) + 0.5::DOUBLE) * {_d(RES)} as x, maxy - (cast(cy as int) + 0.5::DOUBLE) * {_d(RES)} as y,
       cast(NULL as double) as v
from cc""",
    "frame_index": f"""{obs_map()},
{FRAMES}
select name, concat('/data/frames/', name, '.TIF') as path, frame_row, frame_col, minx, maxx, miny, maxy from frames""",
    "scene_frame_join": f"""{obs_map(obs=STRIPS)},
{FRAMES}
select s.scene, f.frame_row, f.frame_col, f.name from se s join frames f
  on s.minx < f.maxx and s.maxx > f.minx and s.miny < f.maxy and s.maxy > f.miny""",
    "pixel_to_frame": f"""{obs_map()},
pa as (select o.scene, o.x, o.y, o.acq, o.l_orderkey,
              least(cast(floor((o.x - s.minx) / {_d(RES)}) as int), s.ncx - 1) as gx,
              least(cast(floor((s.maxy - o.y) / {_d(RES)}) as int), s.ncy - 1) as gy
       from obs o cross join shape s
       where o.x >= s.minx and o.x <= s.maxx and o.y >= s.miny and o.y <= s.maxy),
pb as (select *, cast(floor(gy / {H}) as int) as frame_row, cast(floor(gx / {W}) as int) as frame_col from pa)
select *, gy - frame_row * {H} as cell_row, gx - frame_col * {W} as cell_col from pb""",
    "mosaic_fill": f"{obs_map()}\nselect gx, gy, frame_row, frame_col, cell_row, cell_col, v, n from mosaic",
    "mosaic_fill_first": f"{obs_map(agg='min_by(v, row(acq, l_orderkey, scene, v))')}\nselect gx, gy, frame_row, frame_col, cell_row, cell_col, v, n from mosaic",
    "mosaic_fill_max": f"{obs_map(agg='max(v)')}\nselect gx, gy, frame_row, frame_col, cell_row, cell_col, v, n from mosaic",
    "mosaic_fill_min": f"{obs_map(agg='min(v)')}\nselect gx, gy, frame_row, frame_col, cell_row, cell_col, v, n from mosaic",
    "mosaic_fill_count": f"{obs_map(agg='cast(count(v) as double)')}\nselect gx, gy, frame_row, frame_col, cell_row, cell_col, v, n from mosaic",
    "unplaced_pixels": f"""with {OBS},
px as (select scene, x, case when l_orderkey % 53 = 0 then null else y end as y, acq, l_orderkey from obs),
b as (select min(x) - 250 as minx, (max(x) + 250) / 2 as maxx, min(y) - 250 as miny, max(y) + 250 as maxy
      from px where y is not null)
select px.*, case when y is null then 'no coordinates' else 'outside' end as reason from px cross join b
where y is null or not (x >= b.minx and x <= b.maxx and y >= b.miny and y <= b.maxy)""",
    "extent_format_full": f"""with {EXTENTS},
pe as (select scene, {_parse_extent_sql('plain', 'plain', '')} from extents)
select scene, minx || ' ' || maxx || ' ' || miny || ' ' || maxy as plain_text,
       minx || ' ' || maxx || ' ' || maxy || ' ' || miny as shell_text from pe""",
    "mosaic_fill_mean": f"{obs_map(agg='avg(v)')}\nselect gx, gy, frame_row, frame_col, cell_row, cell_col, round(v, 9) as v, n from mosaic",
    "row_count": f"with {LINES} select count(*) as n from lines",
    "partition_counts": f"with {LINES} select cast(count(*) as bigint) as n, true as once_each from lines",
    "scene_listing": """select distinct 'scene_file=AST_' || strftime(o_orderdate, '%Y%m') || '.hdf' as name from orders
where cast(strftime(o_orderdate, '%Y%m') as int) % 5 <> 0""",
    "unpaired_blocks": f"""with {VNIR}, {SWIR},
v as (select distinct scene, cast(floor(x / 2.0::DOUBLE) as bigint) as px, cast(floor(y / 2.0::DOUBLE) as bigint) as py from vnir where x % 7 > 1),
s as (select scene, px, py from swir where py % 5 > 0)
select *, 'vnir' as has from (select * from v except select * from s)
union all select *, 'swir' as has from (select * from s except select * from v)""",
    "sum_reduce": f"""{_dec()}
select count(*) as attempted, count(error) as rejected, count(case when error is null then 1 end) as accepted from dec""",
    "jdbc_append": f"{_dec()}\nselect {STORED}, line_id from dec where error is null",
    "tolerant_write": f"""with {LINES}, {KEYED},
{decode_ctes('keyed', 'line', 'line_id, rid')},
ranked as (select *, row_number() over (partition by image_id order by _text, line_id, rid) as k
           from dec where error is null and image_id is not null),
old as (select concat('img', cast(c_custkey as varchar)) as image_id from customer where c_custkey % 17 = 0),
why as (select line_id, concat_ws(':', error, error_field) as reason from dec where error is not null
  union all select line_id, 'null key' from dec where error is null and image_id is null
  union all select line_id, case when k > 1 then 'duplicate key'
                                 when image_id in (select image_id from old) then 'key exists' end from ranked)
select line_id, case when reason is null then 'accepted' else 'rejected' end as status, reason from why""",
    "frame_sink": f"{obs_map()}\nselect gx, gy, frame_row, frame_col, v, bit from bin",
    "frame_sink_dense": f"""{obs_map()},
{FRAMES},
cr as (select *, unnest(range(0, {H})) as cy from frames),
cc as (select *, unnest(range(0, {W})) as cx from cr)
select cc.frame_row, cc.frame_col, cast(cy as int) as cell_row, cast(cx as int) as cell_col, bin.v, bin.bit
from cc left join bin on cc.frame_row = bin.frame_row and cc.frame_col = bin.frame_col
  and cc.cy = bin.cell_row and cc.cx = bin.cell_col""",
    "user_index": f"{obs_map(agg='max(v)', index_sql='(b6 - b4) / nullif(b6 + b4, 0)', mask_sql=f'b2 <= {_d(1.05)}', thr=0.5)}\n{SUMMARY}",
    "quoted_split_regex": f"""with {LINES_L},
{split_cte('ssp', 'lines_l', 'l')}
select event_id, cast(unnest(range(1, len(p) + 1)) as int) as pos, unnest(list_transform(p, lambda x: replace(x, ',', ' ||  '))) as part
from ssp""",
    "project_crs": _zones_sql(),
    "extent_from_files": f"{obs_map(obs=OBS)}\nselect scene, minx, maxx, miny, maxy from se",
    "scene_frame_levels": f"""{obs_map(obs=STRIPS)},
sc as (select scene, minx, maxx, miny, maxy from se union all select -1, minx, maxx, miny, maxy from ext),
c1 as (select *, unnest(range(0, greatest(1, cast(ceil((maxx - minx) / 5000.0::DOUBLE) as int)))) as c from ext),
f1 as (select *, unnest(range(0, greatest(1, cast(ceil((maxy - miny) / 4000.0::DOUBLE) as int)))) as r from c1),
small as (select cast(r as int) as frame_row, cast(c as int) as frame_col, concat('r', r::varchar, '_c', c::varchar) as name,
                 minx + c * 5000.0::DOUBLE as minx, minx + (c + 1) * 5000.0::DOUBLE as maxx,
                 maxy - (r + 1) * 4000.0::DOUBLE as miny, maxy - r * 4000.0::DOUBLE as maxy from f1)
select s.scene, f.frame_row, f.frame_col, f.name from sc s join small f
  on s.minx < f.maxx and s.maxx > f.minx and s.miny < f.maxy and s.maxy > f.miny""",
    "mosaic_fill_weighted": f"{obs_map(agg='sum(v * scene) / sum(scene)')}\nselect gx, gy, frame_row, frame_col, cell_row, cell_col, round(v, 9) as v, n from mosaic",
    "footprint_fill": FOOTPRINT,
    "mosaic_incremental": f"{obs_map()}\nselect gx, gy, frame_row, frame_col, cell_row, cell_col, v, n from mosaic",
    "frame_blocks": f"""{obs_map()},
{FRAMES},
cl as (select frame_row, frame_col, cell_row * {W} + cell_col as cell, v, bit from bin),
wd as (select frame_row, frame_col, cell // 64 as word, count(*) as n, sum(1::hugeint << (cell % 64)) as valid,
              coalesce(sum(1::hugeint << (cell % 64)) filter (bit = 1), 0) as hot from cl group by 1, 2, 3),
ew as (select f.frame_row, f.frame_col, unnest(range(0, {(W * H + 63) // 64})) as word from frames f),
aw as (select e.*, coalesce(n, 0) as n, coalesce(valid, 0) as valid, coalesce(hot, 0) as hot from ew e left join wd
         on wd.frame_row = e.frame_row and wd.frame_col = e.frame_col and wd.word = e.word),
sw as (select *, sum(n) over (partition by frame_row, frame_col order by word) - n as start from aw),
bl as (select frame_row, frame_col, cast(sum(n) as int) as n_valid,
         md5(string_agg((case when valid >= 9223372036854775808 then valid - 18446744073709551616 else valid end)::varchar, ',' order by word)) as valid_md5,
         md5(string_agg((case when hot >= 9223372036854775808 then hot - 18446744073709551616 else hot end)::varchar, ',' order by word)) as hot_md5,
         md5(string_agg(start::varchar, ',' order by word)) as starts_md5 from sw group by 1, 2)
select bl.*, coalesce(round(s.v_sum, 6), 0) as v_sum, s.first_v, s.last_v from bl left join
  (select frame_row, frame_col, sum(v) as v_sum, min_by(v, cell) as first_v, max_by(v, cell) as last_v from cl group by 1, 2) s
  on s.frame_row = bl.frame_row and s.frame_col = bl.frame_col""",
    "load_catalog": f"{_dec()}\nselect {STORED} from dec where error is null",
    "load_catalog_keep": f"{_dec()}\nselect line_id, {STORED} from dec",
    "load_catalog_rejects": f"{_dec()}\nselect line_id, _text as line, error, error_field from dec where error is not null",
    "mineral_map": f"{obs_map()}\n{SUMMARY}",
    "mineral_map_dense": f"{obs_map(obs=GAP)},\n{FRAMES}{DENSE_SUMMARY}",
    "mineral_map_lonlat": f"{obs_map(obs=LONLAT)},\n{FRAMES}{DENSE_SUMMARY}",
    "mineral_map_from_bands": f"{obs_map(agg='max_by(v, row(acq, scene, v))', mask_sql='b3 <= b2', obs=FROM_BANDS)}\n{SUMMARY}",
}

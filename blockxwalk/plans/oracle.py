"""Reference SQL (DuckDB dialect) for every registered query.

Each query is written independently of the Spark code path: plain joins,
GROUP BY, window ranking and string aggregation over the driver tables, with
the domain tables rebuilt from the same recipe text as CTEs.  The spatial
waves are brute-force distance joins (every parcel against every line part,
narrowed only by an exact bounding-box condition); the distance of a line and a
rectangle, with or without a hole, is a closed form that Spark's path doesn't use.

``oracle_sql()`` returns ``{query_name: sql}``.  Each SQL text is
``WITH <only the CTEs it needs> SELECT ...``.
"""

from __future__ import annotations

import re

from ..functions import geosql
from ..operators.tiles import EXTENT, ZOOMS
from ..sources import fixtures
from .match import BUFFER_FT, NEAREST_FT
from .streets import LABEL_GENERIC, LABEL_NYPD, LABEL_ZIP_STREETS

# --- SQL snippets mirroring the Column rules -------------------------------------------


def trim_ws(c):
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def digits(c):
    return f"regexp_replace({c}, '\\D', '', 'g')"


def pad_left(c, w):
    return f"lpad({c}, CAST(greatest(length({c}), {w}) AS INTEGER), '0')"


def key_part(c):
    return f"nullif({digits(f'CAST({c} AS VARCHAR)')}, '')"


def bbl_key(b, bl, lt):
    return f"({key_part(b)} || {pad_left(key_part(bl), 5)} || {pad_left(key_part(lt), 4)})"


def bbl_from_number(x):
    s = pad_left(digits(f"printf('%.0f', CAST({x} AS DOUBLE))"), 10)
    return f"(CASE WHEN {x} IS NULL THEN NULL ELSE substring({s}, 1, 10) END)"


def segid_key(x):
    return f"(CASE WHEN {x} IS NULL THEN NULL ELSE {pad_left(f'CAST({x} AS VARCHAR)', 7)} END)"


def na(c):
    return f"coalesce(CAST({c} AS VARCHAR), 'NA')"


def int_text(x):
    return f"(CASE WHEN {x} = round({x}) THEN printf('%.0f', CAST({x} AS DOUBLE)) ELSE CAST({x} AS VARCHAR) END)"


NUM_RX = r"^(?i)[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)$"


def to_double(c):
    t = trim_ws(c)
    return f"(CASE WHEN regexp_matches({t}, '{NUM_RX}') THEN TRY_CAST({t} AS DOUBLE) END)"


def ndna(c):
    """distinct count with NULL as a value"""
    return (f"CAST(count(DISTINCT {c}) + coalesce(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT)")


def cnt():
    return "CAST(count(*) AS BIGINT)"


def count_if(cond):
    return f"CAST(coalesce(sum(CASE WHEN {cond} THEN 1 ELSE 0 END), 0) AS BIGINT)"


def seeded(c, seed=1):
    return f"md5({na(c)} || '#{seed}')"


def six_number(c, src):
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT min({x}) AS min, quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS median, "
            f"round(avg({x}), 6) AS mean, quantile_cont({x}, 0.75) AS q3, max({x}) AS max FROM {src}")


def label(template, cols):
    parts = template.split("%s")
    out = [f"'{parts[0]}'"]
    for c, tail in zip(cols, parts[1:]):
        out += [na(c), f"'{tail}'"]
    return "(" + " || ".join(out) + ")"


SEG_COLS = ("segment_id, legacy_id, physical_id, generic_id, feature_typ, status, segment_typ, traf_dir, rw_type, "
            "street, saf_street_name, nypdid, fdnyid, from_left, to_left, from_right, to_right, l_zip, r_zip, "
            "l_boro, r_boro, l_cd, r_cd, lct2020, rct2020, lcb2020, rcb2020, l_block_face_id, r_block_face_id, "
            "shape_length")
SEG_TO_PHYS = ("segment_id, physical_id, generic_id, nypdid, fdnyid, street, saf_street_name, from_left, to_left, "
               "from_right, to_right, l_zip, r_zip, l_boro, r_boro, l_cd, r_cd, lct2020, rct2020, lcb2020, rcb2020, "
               "l_block_face_id, r_block_face_id, shape_length")
XWALK = ("segment_id, physical_id, generic_id, fdnyid, l_block_face_id, r_block_face_id, lct2020, rct2020, "
         "lcb2020, rcb2020")
EXCL = "NOT coalesce(rw_type IN ('2', '3', '4', '9'), false)"
DRIVABLE = "feature_typ IN ('0', '6') AND status = '2' AND segment_typ = 'U' AND traf_dir IN ('T', 'A', 'W')"

# --- named CTEs (order matters: a CTE may use earlier ones) ------------------------------

CTES: list[tuple[str, str]] = [
    ("fx_segments", fixtures.render("segments")),
    ("fx_parcels", fixtures.render("parcels")),
    ("fx_pad_addr", fixtures.render("pad_addr")),
    ("fx_pad_bill", fixtures.render("pad_bill")),
    ("fx_overrides", fixtures.render("manual_overrides")),
    ("cs", f"SELECT * FROM fx_segments WHERE {DRIVABLE} AND {EXCL}"),
    # spatial forms: lines with a usable part (two distinct vertices), rectangle parcels
    ("ln", "SELECT DISTINCT *, least(x1, x2) AS minx, greatest(x1, x2) AS maxx, least(y1, y2) AS miny, greatest(y1, y2) AS maxy FROM ("
           "SELECT segment_id, physical_id, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1, CAST(x2 AS DOUBLE) AS x2, "
           "CAST(y2 AS DOUBLE) AS y2 FROM cs UNION ALL SELECT segment_id, physical_id, CAST(x3 AS DOUBLE), CAST(y3 AS DOUBLE), "
           "CAST(x4 AS DOUBLE), CAST(y4 AS DOUBLE) FROM cs WHERE x3 IS NOT NULL) WHERE NOT (x1 = x2 AND y1 = y2)"),
    ("pk", f"SELECT *, {bbl_key('boro_code', 'block', 'lot')} AS bbl_chr, {bbl_from_number('appbbl')} AS appbbl_chr, "
           "CAST(xmin AS DOUBLE) AS pxmin, CAST(ymin AS DOUBLE) AS pymin, CAST(xmax AS DOUBLE) AS pxmax, "
           "CAST(ymax AS DOUBLE) AS pymax FROM fx_parcels"),
    ("padk", f"SELECT *, {bbl_key('boro', 'block', 'lot')} AS bbl_chr, {segid_key('segid')} AS segid_chr FROM fx_pad_addr"),
    # --- streets
    ("zp", f"SELECT DISTINCT {trim_ws('l_zip')} AS l_zip, {trim_ws('r_zip')} AS r_zip FROM cs "
           f"WHERE ({trim_ws('l_zip')} IS NOT NULL AND {trim_ws('l_zip')} <> '') "
           f"OR ({trim_ws('r_zip')} IS NOT NULL AND {trim_ws('r_zip')} <> '')"),
    ("ze0", "SELECT DISTINCT l_zip, r_zip FROM zp WHERE l_zip IS NOT NULL AND r_zip IS NOT NULL "
            "AND l_zip <> '' AND r_zip <> '' AND l_zip <> r_zip"),
    ("ze", "SELECT l_zip AS zip1, r_zip AS zip2 FROM ze0 UNION SELECT r_zip AS zip1, l_zip AS zip2 FROM ze0"),
    ("zn", "SELECT zip1, string_agg(zip2, ';' ORDER BY zip2) AS neighbors, CAST(count(*) AS BIGINT) AS degree "
           "FROM ze GROUP BY zip1"),
    ("zseed", f"SELECT zip1 FROM zn WHERE degree >= 3 ORDER BY {seeded('zip1')}, zip1 LIMIT 1"),
    ("zpick", f"SELECT zip2 AS zip FROM ze WHERE zip1 = (SELECT zip1 FROM zseed) ORDER BY {seeded('zip2')}, zip2 LIMIT 3"),
    ("zc", "SELECT zip1 AS zip FROM zseed UNION ALL SELECT zip FROM zpick"),
    ("siz", f"SELECT * FROM cs WHERE coalesce({trim_ws('l_zip')} IN (SELECT zip FROM zc), false) "
            f"OR coalesce({trim_ws('r_zip')} IN (SELECT zip FROM zc), false)"),
    ("gm", f"SELECT generic_id, {ndna('physical_id')} AS n_physical FROM cs WHERE generic_id IS NOT NULL "
           f"GROUP BY generic_id HAVING {ndna('physical_id')} > 1"),
    ("nypd", f"SELECT * FROM cs WHERE nypdid IS NOT NULL AND {trim_ws('nypdid')} <> ''"),
    ("s2p", f"SELECT DISTINCT {SEG_TO_PHYS} FROM cs"),
    # --- blocks
    ("pb_base", "SELECT physical_id, CAST(count(*) AS BIGINT) AS n_segments, "
                "CAST(coalesce(sum(shape_length), 0) AS DOUBLE) AS total_length_ft FROM cs GROUP BY physical_id"),
    ("pb_st", f"SELECT physical_id, string_agg({na('street')}, '; ' ORDER BY f NULLS FIRST, {na('street')}) AS streets "
              "FROM (SELECT physical_id, street, min(segment_id) AS f FROM cs GROUP BY 1, 2) GROUP BY physical_id"),
    ("pb_boro", "SELECT physical_id, l_boro AS boro FROM (SELECT physical_id, l_boro, row_number() OVER (PARTITION BY "
                "physical_id ORDER BY n DESC, l_boro ASC NULLS LAST) AS rn FROM (SELECT physical_id, l_boro, count(*) "
                "AS n FROM cs GROUP BY 1, 2)) WHERE rn = 1"),
    ("pb_cd", "SELECT physical_id, l_cd AS cd FROM (SELECT physical_id, l_cd, row_number() OVER (PARTITION BY "
              "physical_id ORDER BY n DESC, l_cd ASC NULLS LAST) AS rn FROM (SELECT physical_id, l_cd, count(*) "
              "AS n FROM cs GROUP BY 1, 2)) WHERE rn = 1"),
    ("pb_ct", "SELECT physical_id, lct2020 AS ct2020 FROM (SELECT physical_id, lct2020, row_number() OVER (PARTITION BY "
              "physical_id ORDER BY n DESC, lct2020 ASC NULLS LAST) AS rn FROM (SELECT physical_id, lct2020, count(*) "
              "AS n FROM cs GROUP BY 1, 2)) WHERE rn = 1"),
    ("pb", "SELECT b.physical_id, b.n_segments, b.total_length_ft, s.streets, o.boro, c.cd, t.ct2020 FROM pb_base b "
           "LEFT JOIN pb_st s ON b.physical_id IS NOT DISTINCT FROM s.physical_id "
           "LEFT JOIN pb_boro o ON b.physical_id IS NOT DISTINCT FROM o.physical_id "
           "LEFT JOIN pb_cd c ON b.physical_id IS NOT DISTINCT FROM c.physical_id "
           "LEFT JOIN pb_ct t ON b.physical_id IS NOT DISTINCT FROM t.physical_id"),
    ("sa", "SELECT physical_id, segment_id, street, shape_length, least(n0, n1, n2, n3) AS addr_min, "
           "greatest(n0, n1, n2, n3) AS addr_max FROM (SELECT physical_id, segment_id, street, shape_length, "
           f"{to_double('from_left')} AS n0, {to_double('to_left')} AS n1, {to_double('from_right')} AS n2, "
           f"{to_double('to_right')} AS n3 FROM cs)"),
    ("sr", "SELECT physical_id, street, min(addr_min) AS addr_low, max(addr_max) AS addr_high, "
           "CAST(coalesce(sum(shape_length), 0) AS DOUBLE) AS street_length, CAST(count(*) AS BIGINT) AS n_segments, "
           "max(addr_max) - min(addr_min) AS addr_span FROM sa WHERE addr_min IS NOT NULL AND addr_max IS NOT NULL "
           "AND isfinite(addr_min) AND isfinite(addr_max) GROUP BY physical_id, street"),
    ("na_auto", f"SELECT physical_id, {int_text('addr_low')} || '-' || {int_text('addr_high')} || ' ' || {na('street')} "
                "AS block_name, street AS primary_street, addr_low, addr_high, 'auto' AS name_source FROM "
                "(SELECT *, row_number() OVER (PARTITION BY physical_id ORDER BY street_length DESC NULLS LAST, "
                "addr_span DESC NULLS LAST, street ASC NULLS LAST) AS rn FROM sr) WHERE rn = 1"),
    ("na_none", "SELECT physical_id, '[No addr] ' || coalesce(CASE WHEN length(ps) > 40 THEN substring(ps, 1, 37) || '...' "
                "ELSE ps END, 'NA') AS block_name, ps AS primary_street, CAST(NULL AS DOUBLE) AS addr_low, "
                "CAST(NULL AS DOUBLE) AS addr_high, 'auto_no_addr' AS name_source FROM (SELECT physical_id, "
                "CASE WHEN regexp_matches(streets, '^[^;]+') THEN regexp_extract(streets, '^[^;]+', 0) END AS ps "
                "FROM pb b WHERE NOT EXISTS (SELECT 1 FROM na_auto a WHERE a.physical_id IS NOT DISTINCT FROM b.physical_id))"),
    ("nauto", "SELECT * FROM na_auto UNION ALL SELECT * FROM na_none"),
    ("nm", "SELECT a.physical_id, coalesce(o.block_name_manual, a.block_name) AS block_name, "
           "coalesce(o.primary_street_manual, a.primary_street) AS primary_street, "
           "coalesce(o.addr_low_manual, a.addr_low) AS addr_low, coalesce(o.addr_high_manual, a.addr_high) AS addr_high, "
           "CASE WHEN o.block_name_manual IS NOT NULL THEN 'manual' ELSE a.name_source END AS name_source, o.notes "
           "FROM nauto a LEFT JOIN fx_overrides o ON a.physical_id IS NOT DISTINCT FROM o.physical_id"),
    ("rv", "SELECT n.*, b.boro, b.cd, b.streets, CASE WHEN n.addr_low IS NULL THEN 'no_addresses' "
           "WHEN n.addr_high - n.addr_low > 500 THEN 'large_address_span' WHEN n.addr_high - n.addr_low = 0 "
           "THEN 'single_address' ELSE 'other' END AS review_reason FROM (SELECT * FROM nm WHERE "
           "name_source = 'auto_no_addr' OR regexp_matches(block_name, '^\\[No addr\\]') OR "
           "(addr_high - addr_low > 500 AND addr_low IS NOT NULL) OR (addr_high - addr_low = 0 AND addr_low IS NOT NULL) "
           "OR addr_low IS NULL) n LEFT JOIN pb b ON n.physical_id IS NOT DISTINCT FROM b.physical_id"),
    ("xw", f"SELECT DISTINCT {XWALK} FROM cs"),
    ("bis_v", "SELECT physical_id, a, v, min({'side': side, 'k': k}) AS f FROM ("
              f"SELECT physical_id, 0 AS a, {na('segment_id')} AS v, 0 AS side, segment_id AS k FROM xw UNION ALL "
              f"SELECT physical_id, 1, {na('generic_id')}, 0, segment_id FROM xw UNION ALL "
              f"SELECT physical_id, 2, {na('fdnyid')}, 0, segment_id FROM xw UNION ALL "
              f"SELECT physical_id, 3, {na('l_block_face_id')}, 0, segment_id FROM xw UNION ALL "
              f"SELECT physical_id, 3, {na('r_block_face_id')}, 1, segment_id FROM xw UNION ALL "
              f"SELECT physical_id, 4, {na('lct2020')}, 0, segment_id FROM xw UNION ALL "
              f"SELECT physical_id, 4, {na('rct2020')}, 1, segment_id FROM xw UNION ALL "
              f"SELECT physical_id, 5, {na('lcb2020')}, 0, segment_id FROM xw UNION ALL "
              f"SELECT physical_id, 5, {na('rcb2020')}, 1, segment_id FROM xw"
              ") GROUP BY physical_id, a, v"),
    ("bis", "SELECT physical_id, "
            "string_agg(v, ';' ORDER BY f.side, f.k, v) FILTER (WHERE a = 0) AS segment_ids, "
            "CAST(count(*) FILTER (WHERE a = 0) AS BIGINT) AS n_segments, "
            "string_agg(v, ';' ORDER BY f.side, f.k, v) FILTER (WHERE a = 1) AS generic_ids, "
            "string_agg(v, ';' ORDER BY f.side, f.k, v) FILTER (WHERE a = 2) AS fdny_ids, "
            "string_agg(v, ';' ORDER BY f.side, f.k, v) FILTER (WHERE a = 3) AS block_face_ids, "
            "string_agg(v, ';' ORDER BY f.side, f.k, v) FILTER (WHERE a = 4) AS census_tracts_2020, "
            "string_agg(v, ';' ORDER BY f.side, f.k, v) FILTER (WHERE a = 5) AS census_blocks_2020 FROM bis_v GROUP BY physical_id"),
    ("mb", "SELECT b.physical_id, b.n_segments, b.total_length_ft, b.boro, b.cd, b.ct2020, n.block_name, "
           "n.primary_street, n.addr_low, n.addr_high, n.name_source, s.census_tracts_2020, s.census_blocks_2020 "
           "FROM pb b LEFT JOIN nm n ON b.physical_id IS NOT DISTINCT FROM n.physical_id "
           "LEFT JOIN bis s ON b.physical_id IS NOT DISTINCT FROM s.physical_id"),
    # --- matching
    ("sl0", "SELECT DISTINCT segment_id, physical_id, legacy_id FROM cs"),
    ("sl", f"SELECT DISTINCT * FROM (SELECT {segid_key('segment_id')} AS segid_chr, segment_id, physical_id FROM sl0 "
           f"UNION ALL SELECT {segid_key('legacy_id')} AS segid_chr, segment_id, physical_id FROM sl0) "
           "WHERE segid_chr IS NOT NULL AND segment_id IS NOT NULL"),
    ("allb", "SELECT DISTINCT bbl_chr FROM pk"),
    ("w1", "SELECT DISTINCT k.bbl_chr, l.segment_id, l.physical_id, 'W1_PAD' AS source FROM padk k "
           "JOIN sl l ON k.segid_chr = l.segid_chr WHERE k.bbl_chr IS NOT NULL AND k.segid_chr IS NOT NULL"),
    ("r1", "SELECT bbl_chr FROM allb a WHERE NOT EXISTS (SELECT 1 FROM w1 m WHERE m.bbl_chr IS NOT DISTINCT FROM a.bbl_chr)"),
    ("w2a", "SELECT DISTINCT r.bbl_chr, w.segment_id, w.physical_id, 'W2_APPBBL' AS source FROM r1 r "
            "JOIN (SELECT bbl_chr, appbbl_chr FROM pk WHERE appbbl_chr IS NOT NULL) p ON r.bbl_chr IS NOT DISTINCT FROM p.bbl_chr "
            "JOIN w1 w ON p.appbbl_chr = w.bbl_chr"),
    ("r2a", "SELECT bbl_chr FROM r1 a WHERE NOT EXISTS (SELECT 1 FROM w2a m WHERE m.bbl_chr IS NOT DISTINCT FROM a.bbl_chr)"),
    ("bill", f"SELECT * FROM (SELECT {bbl_key('billboro', 'billblock', 'billlot')} AS billbbl, "
             f"{bbl_key('loboro', 'loblock', 'lolot')} AS lobbl FROM fx_pad_bill) WHERE billbbl IS NOT NULL AND lobbl IS NOT NULL"),
    ("w2b", "SELECT DISTINCT r.bbl_chr, l.segment_id, l.physical_id, 'W2_BILLING' AS source FROM r2a r "
            "JOIN bill b ON r.bbl_chr = b.billbbl JOIN padk k ON b.lobbl = k.bbl_chr "
            "JOIN sl l ON k.segid_chr = l.segid_chr WHERE k.segid_chr IS NOT NULL"),
    ("r2b", "SELECT bbl_chr FROM r2a a WHERE NOT EXISTS (SELECT 1 FROM w2b m WHERE m.bbl_chr IS NOT DISTINCT FROM a.bbl_chr)"),
]


def _seg_meets_rect(x0, y0, x1, y1):
    """Whether line l meets the closed rectangle, by the range of its parameter inside each strip."""
    def strip(a, d, lo, hi):
        t = (f"(({lo} - {a}) / nullif({d}, 0))", f"(({hi} - {a}) / nullif({d}, 0))")
        return (f"(CASE WHEN {d} = 0 THEN CASE WHEN {a} BETWEEN {lo} AND {hi} THEN 0 ELSE 2 END ELSE least({t[0]}, {t[1]}) END)",
                f"(CASE WHEN {d} = 0 THEN 1 ELSE greatest({t[0]}, {t[1]}) END)")
    (xa, xb), (ya, yb) = strip("l.x1", "(l.x2 - l.x1)", x0, x1), strip("l.y1", "(l.y2 - l.y1)", y0, y1)
    return f"greatest(0, {xa}, {ya}) <= least(1, {xb}, {yb})"


def _rect_dist():
    """Closed-form distance of line l and rectangle p, which may have a rectangular hole."""
    def end(x, y):  # end point to rectangle
        return f"sqrt(pow(greatest(p.pxmin - {x}, 0, {x} - p.pxmax), 2) + pow(greatest(p.pymin - {y}, 0, {y} - p.pymax), 2))"

    def corner(x, y):  # corner to line: by its foot's parameter, kept in [0, 1]
        dx, dy = "(l.x2 - l.x1)", "(l.y2 - l.y1)"
        t = f"greatest(0, least(1, (({x} - l.x1) * {dx} + ({y} - l.y1) * {dy}) / ({dx} * {dx} + {dy} * {dy})))"
        return f"sqrt(pow({x} - l.x1 - {t} * {dx}, 2) + pow({y} - l.y1 - {t} * {dy}, 2))"

    def in_hole(x, y):
        return f"({x} > p.hx0 AND {x} < p.hx1 AND {y} > p.hy0 AND {y} < p.hy1)"

    ends = [("l.x1", "l.y1"), ("l.x2", "l.y2")]
    apart = ", ".join([end(*e) for e in ends] + [corner(x, y) for x in ("p.pxmin", "p.pxmax") for y in ("p.pymin", "p.pymax")])
    hole = ", ".join(f"{x} - p.hx0, p.hx1 - {x}, {y} - p.hy0, p.hy1 - {y}" for x, y in ends)
    return (f"CASE WHEN p.hx0 IS NOT NULL AND {in_hole(*ends[0])} AND {in_hole(*ends[1])} THEN least({hole}) "
            f"WHEN {_seg_meets_rect('p.pxmin', 'p.pymin', 'p.pxmax', 'p.pymax')} THEN 0.0 ELSE least({apart}) END")


POLY = "bbl_chr, pxmin, pymin, pxmax, pymax, hx0, hy0, hx1, hy1"


def _pairs_within(parcels: str, radius: float) -> str:
    """The nearest part of each line key, by distinct parcel row."""
    r = float(radius)
    return (f"SELECT {POLY}, segment_id, physical_id, min(dist_ft) AS dist_ft FROM (SELECT p.*, l.segment_id, l.physical_id, {_rect_dist()} AS dist_ft "
            f"FROM (SELECT DISTINCT {POLY} FROM {parcels}) p JOIN ln l ON l.maxx >= p.pxmin - {r} AND l.minx <= p.pxmax + {r} "
            f"AND l.maxy >= p.pymin - {r} AND l.miny <= p.pymax + {r}) GROUP BY ALL")


def _nearest(pairs: str) -> str:
    return ("SELECT bbl_chr, segment_id, physical_id, min(dist_ft) AS dist_ft FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {POLY} ORDER BY dist_ft, segment_id, physical_id) AS rn "
            f"FROM {pairs}) WHERE rn = 1 GROUP BY bbl_chr, segment_id, physical_id")


CTES += [
    ("p3", "SELECT * FROM pk p WHERE EXISTS (SELECT 1 FROM r2b r WHERE r.bbl_chr IS NOT DISTINCT FROM p.bbl_chr)"),
    ("p3pairs", f"SELECT * FROM ({_pairs_within('p3', BUFFER_FT)}) WHERE dist_ft <= {float(BUFFER_FT)}"),
    ("w3", "SELECT DISTINCT bbl_chr, segment_id, physical_id, 'W3_BUFFER50' AS source FROM p3pairs"),
    ("r3", "SELECT bbl_chr FROM r2b a WHERE NOT EXISTS (SELECT 1 FROM w3 m WHERE m.bbl_chr IS NOT DISTINCT FROM a.bbl_chr)"),
    ("p4", "SELECT * FROM pk p WHERE EXISTS (SELECT 1 FROM r3 r WHERE r.bbl_chr IS NOT DISTINCT FROM p.bbl_chr)"),
    ("p4pairs", f"SELECT * FROM ({_pairs_within('p4', NEAREST_FT)}) WHERE dist_ft <= {float(NEAREST_FT)}"),
    ("w4", f"SELECT bbl_chr, segment_id, physical_id, 'W4_NEAREST150' AS source FROM ({_nearest('p4pairs')})"),
    ("r4", "SELECT bbl_chr FROM r3 a WHERE NOT EXISTS (SELECT 1 FROM w4 m WHERE m.bbl_chr IS NOT DISTINCT FROM a.bbl_chr)"),
    ("allw", "SELECT * FROM w1 UNION ALL SELECT * FROM w2a UNION ALL SELECT * FROM w2b UNION ALL "
             "SELECT * FROM w3 UNION ALL SELECT * FROM w4"),
    ("bsp", "SELECT DISTINCT bbl_chr, segment_id, physical_id, source FROM allw"),
    ("b2p", "SELECT DISTINCT bbl_chr, physical_id, source FROM bsp"),
    ("b2s", "SELECT DISTINCT bbl_chr, segment_id, source FROM bsp"),
    ("bin2bbl", f"SELECT DISTINCT bin, bbl_chr FROM padk WHERE bin IS NOT NULL AND bin <> 0 AND bbl_chr IS NOT NULL"),
    ("bin2p", "SELECT DISTINCT b.bin, b.bbl_chr, p.physical_id FROM bin2bbl b JOIN b2p p ON b.bbl_chr IS NOT DISTINCT FROM p.bbl_chr"),
    ("addr", "SELECT DISTINCT p.physical_id, a.address, a.bin, a.bbl_chr, a.boro, a.zip FROM (SELECT bbl_chr, bin, "
             f"{na('coalesce(lhnd, hhnd)')} || ' ' || {na('stname')} AS address, boro, zipcode AS zip FROM padk "
             "WHERE bbl_chr IS NOT NULL) a JOIN b2p p ON a.bbl_chr IS NOT DISTINCT FROM p.bbl_chr"),
    ("apb", "SELECT physical_id, CAST(count(*) AS BIGINT) AS n_addresses FROM addr GROUP BY physical_id"),
    ("mf", "SELECT m.*, c1.n_bbls, c2.n_bins, c3.n_addresses FROM mb m "
           "LEFT JOIN (SELECT physical_id, CAST(count(*) AS BIGINT) AS n_bbls FROM b2p GROUP BY physical_id) c1 "
           "ON m.physical_id IS NOT DISTINCT FROM c1.physical_id "
           "LEFT JOIN (SELECT physical_id, CAST(count(*) AS BIGINT) AS n_bins FROM bin2p GROUP BY physical_id) c2 "
           "ON m.physical_id IS NOT DISTINCT FROM c2.physical_id "
           "LEFT JOIN apb c3 ON m.physical_id IS NOT DISTINCT FROM c3.physical_id"),
    ("um", "SELECT bbl_chr, boro_code, block, lot, address, land_use, owner_type, owner_name FROM pk p "
           "WHERE EXISTS (SELECT 1 FROM r4 r WHERE r.bbl_chr IS NOT DISTINCT FROM p.bbl_chr)"),
]


# the waves without the billing table: those after it start from what remains before it
_NO_BILLING = ("r2b", "r2a"), ("p3", "p3n"), ("p3pairs", "p3pairsn"), ("w3", "w3n"), ("r3", "r3n"), ("p4", "p4n"), ("p4pairs", "p4pairsn"), ("w4", "w4n")
for _name in ("p3", "p3pairs", "w3", "r3", "p4", "p4pairs", "w4", "r4"):
    _sql = dict(CTES)[_name]
    for _a, _b in _NO_BILLING:
        _sql = re.sub(rf"\b{_a}\b", _b, _sql)
    CTES.append((f"{_name}n", _sql))

# level and upright lines on a small grid, cut by plain interval conditions
CTES += [
    ("gl", "SELECT DISTINCT physical_id, CAST(segment_id * 31 % 12 AS DOUBLE) AS y, CAST(segment_id * 17 % 100 AS DOUBLE) AS a, "
           "CAST(segment_id * 17 % 100 + 5 + segment_id % 50 AS DOUBLE) AS b FROM cs"),
    ("gu", "SELECT DISTINCT physical_id, CAST(segment_id * 13 % 20 AS DOUBLE) AS x, CAST(segment_id * 7 % 60 AS DOUBLE) AS a, "
           "CAST(segment_id * 7 % 60 + 5 + segment_id % 40 AS DOUBLE) AS b FROM cs"),
    ("gcl", "SELECT physical_id, y, a, b, a AS c FROM gl UNION SELECT physical_id, y, a, b, b FROM gl "
            "UNION SELECT l.physical_id, l.y, l.a, l.b, u.x FROM gl l JOIN gu u ON l.physical_id IS NOT DISTINCT FROM u.physical_id AND u.x BETWEEN l.a AND l.b AND l.y BETWEEN u.a AND u.b "
            "UNION SELECT l.physical_id, l.y, l.a, l.b, e.c FROM gl l JOIN (SELECT physical_id, y, a AS c FROM gl UNION SELECT physical_id, y, b FROM gl) e "
            "ON l.physical_id IS NOT DISTINCT FROM e.physical_id AND l.y = e.y AND e.c BETWEEN l.a AND l.b"),
    ("gcu", "SELECT physical_id, x, a, b, a AS c FROM gu UNION SELECT physical_id, x, a, b, b FROM gu "
            "UNION SELECT u.physical_id, u.x, u.a, u.b, l.y FROM gu u JOIN gl l ON l.physical_id IS NOT DISTINCT FROM u.physical_id AND u.x BETWEEN l.a AND l.b AND l.y BETWEEN u.a AND u.b "
            "UNION SELECT u.physical_id, u.x, u.a, u.b, e.c FROM gu u JOIN (SELECT physical_id, x, a AS c FROM gu UNION SELECT physical_id, x, b FROM gu) e "
            "ON u.physical_id IS NOT DISTINCT FROM e.physical_id AND u.x = e.x AND e.c BETWEEN u.a AND u.b"),
    ("nod", "SELECT DISTINCT physical_id, c AS x1, y AS y1, d AS x2, y AS y2 FROM (SELECT *, lead(c) OVER (PARTITION BY physical_id, y, a, b ORDER BY c) AS d FROM gcl) WHERE d IS NOT NULL "
            "UNION SELECT DISTINCT physical_id, x, c, x, d FROM (SELECT *, lead(c) OVER (PARTITION BY physical_id, x, a, b ORDER BY c) AS d FROM gcu) WHERE d IS NOT NULL"),
]


def _vertices(src: str, template: str, cols) -> str:
    """Flat vertex rows of a reprojected layer of lines of one or two parts (oracle of map layers)."""
    lab = label(template, cols)
    rows = []
    first = "NOT (x1 = x2 AND y1 = y2)"
    parts = ((("x1", "y1"), ("x2", "y2")), "0", first), ((("x3", "y3"), ("x4", "y4")), f"CASE WHEN {first} THEN 1 ELSE 0 END", "x3 IS NOT NULL")
    for ends, part, usable in parts:
        for i, (x, y) in enumerate(ends):
            xs, ys = f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)"
            lon, t, phi0 = geosql.lcc_inverse_parts(xs, ys)
            rows.append(f"SELECT segment_id, {lab} AS label_text, CAST({part} AS BIGINT) AS part_no, CAST({i} AS BIGINT) "
                        f"AS vertex_no, {lon} AS lon, {t} AS t, {phi0} AS ph0 FROM {src} WHERE {usable}")
    layers = "SELECT * FROM (" + " UNION ALL ".join(rows) + ")"
    # unrolled latitude iteration, one layer per step
    prev = "ph0"
    cur = layers
    for k in range(1, geosql.LAT_ITERATIONS + 1):
        cur = f"SELECT *, {geosql.lat_step('t', prev)} AS ph{k} FROM ({cur})"
        prev = f"ph{k}"
    return (f"SELECT segment_id, label_text, part_no, vertex_no, round(lon, 6) AS lon, "
            f"round(degrees({prev}), 6) AS lat FROM ({cur})")


def _tiles(src: str, zooms=ZOOMS) -> str:
    """What each tile of a layer of lines holds, an edge at a time."""
    first = "NOT (x1 = x2 AND y1 = y2)"
    ends = " UNION ALL ".join(f"SELECT segment_id, {xs} FROM {src} WHERE {w}" for xs, w in (
        ("CAST(x1 AS DOUBLE) AS xa, CAST(y1 AS DOUBLE) AS ya, CAST(x2 AS DOUBLE) AS xb, CAST(y2 AS DOUBLE) AS yb", first),
        ("CAST(x3 AS DOUBLE), CAST(y3 AS DOUBLE), CAST(x4 AS DOUBLE), CAST(y4 AS DOUBLE)", "x3 IS NOT NULL")))
    cols = []
    for p in "ab":
        lon, t, phi = geosql.lcc_inverse_parts(f"x{p}", f"y{p}")
        cols += [f"{lon} AS lon{p}", f"{t} AS t{p}", f"{phi} AS {p}0"]
    cur = f"SELECT segment_id, {', '.join(cols)} FROM ({ends})"
    for k in range(1, geosql.LAT_ITERATIONS + 1):
        cur = f"SELECT *, {geosql.lat_step('ta', f'a{k - 1}')} AS a{k}, {geosql.lat_step('tb', f'b{k - 1}')} AS b{k} FROM ({cur})"
    n = geosql.LAT_ITERATIONS
    merc = lambda p: f"0.5 - ln((1 + sin(radians(degrees({p}{n})))) / (1 - sin(radians(degrees({p}{n}))))) / (4 * pi())"
    world = f"SELECT segment_id, (lona + 180) / 360 AS xa, {merc('a')} AS ya, (lonb + 180) / 360 AS xb, {merc('b')} AS yb FROM ({cur})"
    zoomed = f"SELECT segment_id, zoom, xa * pow(2, zoom) AS xa, ya * pow(2, zoom) AS ya, xb * pow(2, zoom) AS xb, yb * pow(2, zoom) AS yb FROM ({world}), (VALUES {', '.join(f'({z})' for z in zooms)}) AS z(zoom)"
    # every tile of the edge's box, clipped by all four borders at once
    boxed = ("SELECT *, unnest(range(CAST(floor(least(ya, yb)) AS BIGINT), CAST(floor(greatest(ya, yb)) AS BIGINT) + 1)) AS ty FROM (SELECT *, xb - xa AS dx, yb - ya AS dy, "
             f"unnest(range(CAST(floor(least(xa, xb)) AS BIGINT), CAST(floor(greatest(xa, xb)) AS BIGINT) + 1)) AS tx FROM ({zoomed}))")
    side = lambda a, d, t, f, z: f"CASE WHEN {d} = 0 THEN {z} ELSE {f}(({t} - {a}) / {d}, ({t} + 1 - {a}) / {d}) END"
    clipped = (f"SELECT *, greatest(0, {side('xa', 'dx', 'tx', 'least', 0)}, {side('ya', 'dy', 'ty', 'least', 0)}) AS u0, "
               f"least(1, {side('xa', 'dx', 'tx', 'greatest', 1)}, {side('ya', 'dy', 'ty', 'greatest', 1)}) AS u1 FROM ({boxed})")
    at = lambda a, u: f"CAST(floor(({a}a + {u} * d{a} - t{a}) * {EXTENT} + 0.5) AS BIGINT)"
    pieces = f"SELECT segment_id, zoom, tx, ty, {at('x', 'u0')} AS x1, {at('y', 'u0')} AS y1, {at('x', 'u1')} AS x2, {at('y', 'u1')} AS y2 FROM ({clipped}) WHERE u0 <= u1"
    key = "array_to_string(list_transform(range(zoom - 1, -1, -1), lambda i: ((tx >> i) & 1) + 2 * ((ty >> i) & 1)), '')"
    return (f"SELECT zoom, tx, ty, {key} AS quadkey, n_lines, n_pieces FROM (SELECT zoom, tx, ty, CAST(count(DISTINCT segment_id) AS BIGINT) AS n_lines, {cnt()} AS n_pieces "
            f"FROM ({pieces}) WHERE x1 <> x2 OR y1 <> y2 GROUP BY zoom, tx, ty)")


_ALL_NEAR = f"(SELECT * FROM ({_pairs_within('pk', NEAREST_FT)}) WHERE dist_ft <= {float(NEAREST_FT)})"

# --- final queries --------------------------------------------------------------------

QUERIES: dict[str, str] = {
    "city_streets": f"SELECT {SEG_COLS} FROM cs",
    "street_filter_qa": ("SELECT CAST(count(*) AS BIGINT) AS n_physical_streets, CAST(coalesce(sum(c), 0) AS BIGINT) "
                         f"AS n_physical_city_streets FROM (SELECT physical_id, max(CASE WHEN {EXCL} THEN 1 ELSE 0 END) AS c "
                         f"FROM fx_segments WHERE {DRIVABLE} GROUP BY physical_id)"),
    "segments_per_block": six_number("n", "(SELECT physical_id, count(*) AS n FROM fx_segments GROUP BY physical_id)"),
    "id_cardinality": (f"SELECT {ndna('segment_id')} AS n_segment_id, {ndna('physical_id')} AS n_physical_id, "
                       f"{ndna('generic_id')} AS n_generic_id FROM cs"),
    "zip_pairs": "SELECT * FROM zp",
    "zip_edges": "SELECT * FROM ze",
    "zip_neighbors": "SELECT * FROM zn",
    "zip_cluster": "SELECT * FROM zc",
    "streets_in_zips": f"SELECT {SEG_COLS} FROM siz",
    "generic_multi": "SELECT * FROM gm",
    "generic_multi_segments": f"SELECT {SEG_COLS} FROM cs WHERE generic_id IN (SELECT generic_id FROM gm)",
    "nypd_streets": f"SELECT {SEG_COLS} FROM nypd",
    "seg_to_physical": "SELECT * FROM s2p",
    "seg_to_physical_qa": (f"SELECT {cnt()} AS n_rows, {ndna('physical_id')} AS n_physical_id, "
                           f"{ndna('generic_id')} AS n_generic_id, {ndna('nypdid')} AS n_nypdid FROM s2p"),
    "map_layer": _vertices("siz", LABEL_ZIP_STREETS, ("street", "physical_id", "segment_id", "generic_id")),
    "map_layer_generic": _vertices("(SELECT * FROM cs WHERE generic_id IN (SELECT generic_id FROM gm))", LABEL_GENERIC,
                                   ("street", "generic_id", "physical_id", "segment_id")),
    "map_layer_nypd": _vertices("nypd", LABEL_NYPD, ("street", "nypdid", "physical_id", "segment_id", "generic_id")),
    "map_tiles": _tiles("nypd"),
    "physical_blocks": "SELECT * FROM pb",
    "block_parts": ("SELECT physical_id, CAST(v AS BIGINT) AS vertex_no, CASE WHEN v = 0 THEN x1 ELSE x2 END AS x, "
                    "CASE WHEN v = 0 THEN y1 ELSE y2 END AS y FROM (SELECT DISTINCT physical_id, x1, y1, x2, y2 FROM ln) "
                    "CROSS JOIN (VALUES (0), (1)) AS vv(v)"),
    "block_lines": "SELECT * FROM nod",
    "block_nodes": (f"SELECT physical_id, x, y, {cnt()} AS degree FROM (SELECT physical_id, x1 AS x, y1 AS y FROM nod UNION ALL "
                    "SELECT physical_id, x2, y2 FROM nod) GROUP BY physical_id, x, y"),
    "block_id_chunks": (f"SELECT physical_id, list, chunk, {cnt()} AS n_values, string_agg(v, ';' ORDER BY n) AS text FROM ("
                        "SELECT *, (n - 1) // 4 AS chunk FROM (SELECT physical_id, CASE a WHEN 0 THEN 'segment_ids' WHEN 1 THEN 'generic_ids' "
                        "WHEN 2 THEN 'fdny_ids' WHEN 3 THEN 'block_face_ids' WHEN 4 THEN 'census_tracts_2020' ELSE 'census_blocks_2020' END AS list, v, "
                        "row_number() OVER (PARTITION BY physical_id, a ORDER BY f.side, f.k, v) AS n FROM bis_v)) GROUP BY physical_id, list, chunk"),
    "overrides_round_trip": "SELECT * FROM fx_overrides",
    "features_round_trip": " UNION ALL ".join(
        [f"SELECT DISTINCT 'parcels' AS layer, address AS id, CAST({part} AS BIGINT) AS part_no, CAST({v} AS BIGINT) AS vertex_no, "
         f"CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM fx_parcels WHERE {x} IS NOT NULL"
         for part, (x0, y0, x1, y1) in enumerate([("xmin", "ymin", "xmax", "ymax"), ("hx0", "hy0", "hx1", "hy1")])
         for v, (x, y) in enumerate([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)])]
        + [f"SELECT DISTINCT '{layer}' AS layer, CAST(segment_id AS VARCHAR) AS id, CAST({part} AS BIGINT) AS part_no, CAST({v} AS BIGINT) AS vertex_no, "
           f"CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM fx_segments WHERE {x} IS NOT NULL"
           for layer in ("lines", "text") for part, v, x, y in [(0, 0, "x1", "y1"), (0, 1, "x2", "y2"), (1, 0, "x3", "y3"), (1, 1, "x4", "y4")]]),
    "sorted_table": ("SELECT *, row_number() OVER (ORDER BY bbl_chr ASC NULLS LAST, physical_id ASC NULLS LAST, source ASC NULLS LAST) - 1 AS place FROM b2p"),
    "waves_without_billing": " UNION ALL ".join(
        f"SELECT {i} AS wave_no, '{tag}' AS wave, (SELECT {cnt()} FROM {w}) AS pairs_added, "
        f"(SELECT {ndna('bbl_chr')} FROM {w}) AS keys_matched, (SELECT {cnt()} FROM {r}) AS remaining"
        for i, (tag, w, r) in enumerate([("W1_PAD", "w1", "r1"), ("W2_APPBBL", "w2a", "r2a"), ("W3_BUFFER50", "w3n", "r3n"), ("W4_NEAREST150", "w4n", "r4n")], start=1)),
    "run_counts": " UNION ALL ".join(
        [f"SELECT 'wave {tag}' AS stage, 'pairs_added' AS counter, (SELECT {cnt()} FROM {w}) AS n UNION ALL SELECT 'wave {tag}', 'keys_matched', "
         f"(SELECT {ndna('bbl_chr')} FROM {w}) UNION ALL SELECT 'wave {tag}', 'remaining', (SELECT {cnt()} FROM {r})"
         for tag, w, r in [("W1_PAD", "w1", "r1"), ("W2_APPBBL", "w2a", "r2a"), ("W2_BILLING", "w2b", "r2b"), ("W3_BUFFER50", "w3", "r3"), ("W4_NEAREST150", "w4", "r4")]]
        + [f"SELECT 'crosswalk', 'bbl_physical_pairs', (SELECT {cnt()} FROM b2p)", f"SELECT 'crosswalk', 'bbls_matched', (SELECT {ndna('bbl_chr')} FROM b2p)",
           f"SELECT 'crosswalk', 'physical_ids_with_bbls', (SELECT {ndna('physical_id')} FROM b2p)", f"SELECT 'crosswalk', 'bbls_unmatched', (SELECT {cnt()} FROM r4)"]),
    "street_ranges": "SELECT * FROM sr",
    "names_auto": "SELECT * FROM nauto",
    "names_merged": "SELECT * FROM nm",
    "name_coverage": (f"SELECT {count_if('addr_low IS NOT NULL')} AS blocks_with_addresses, "
                      f"{count_if('addr_low IS NULL')} AS blocks_without_addresses FROM nm"),
    "names_by_source": f"SELECT name_source, {cnt()} AS n_blocks FROM nm GROUP BY name_source",
    "name_sample": (f"SELECT physical_id, block_name, name_source FROM nm WHERE addr_low IS NOT NULL "
                    f"ORDER BY {seeded('physical_id')}, physical_id NULLS LAST LIMIT 15"),
    "review": "SELECT * FROM rv",
    "review_counts": f"SELECT review_reason, {cnt()} AS n_blocks FROM rv GROUP BY review_reason",
    "id_crosswalk": "SELECT * FROM xw",
    "id_crosswalk_qa": (f"SELECT {cnt()} AS n_rows, {ndna('physical_id')} AS n_physical_id, "
                        f"{ndna('segment_id')} AS n_segment_id, {ndna('generic_id')} AS n_generic_id FROM xw"),
    "block_ids": ("SELECT physical_id, CASE a WHEN 0 THEN 'segment_ids' WHEN 1 THEN 'generic_ids' WHEN 2 THEN 'fdny_ids' "
                  "WHEN 3 THEN 'block_face_ids' WHEN 4 THEN 'census_tracts_2020' ELSE 'census_blocks_2020' END AS list, v AS value FROM bis_v"),
    "block_id_summary": "SELECT * FROM bis",
    "master": "SELECT * FROM mb",
    "master_totals": (f"SELECT {cnt()} AS total_blocks, CAST(sum(n_segments) AS BIGINT) AS total_segments, "
                      "round(coalesce(sum(total_length_ft), 0) / 5280.0, 6) AS total_length_miles, "
                      f"{count_if('addr_low IS NOT NULL')} AS blocks_with_addresses, "
                      f"{count_if('addr_low IS NULL')} AS blocks_no_addresses, {ndna('boro')} AS n_boroughs FROM mb"),
    "master_by_boro": f"SELECT boro, {cnt()} AS n_blocks FROM mb GROUP BY boro",
    "master_by_source": f"SELECT name_source, {cnt()} AS n_blocks FROM mb GROUP BY name_source",
    "segment_lookup": "SELECT * FROM sl",
    "match_inputs": f"SELECT (SELECT {ndna('bbl_chr')} FROM pk) AS total_bbls, (SELECT {cnt()} FROM sl) AS lookup_rows",
    "wave1": "SELECT * FROM w1",
    "wave2a": "SELECT * FROM w2a",
    "wave2b": "SELECT * FROM w2b",
    "wave3": "SELECT * FROM w3",
    "wave4": "SELECT * FROM w4",
    "wave_qa": " UNION ALL ".join(
        f"SELECT {i} AS wave_no, '{tag}' AS wave, (SELECT {cnt()} FROM {w}) AS pairs_added, "
        f"(SELECT {ndna('bbl_chr')} FROM {w}) AS keys_matched, (SELECT {cnt()} FROM {r}) AS remaining"
        for i, (tag, w, r) in enumerate([("W1_PAD", "w1", "r1"), ("W2_APPBBL", "w2a", "r2a"),
                                         ("W2_BILLING", "w2b", "r2b"), ("W3_BUFFER50", "w3", "r3"),
                                         ("W4_NEAREST150", "w4", "r4")], start=1)),
    "within_50": (f"SELECT bbl_chr, segment_id, physical_id, round(dist_ft, 6) AS dist_ft FROM "
                  f"({_pairs_within('pk', BUFFER_FT)}) WHERE dist_ft <= {float(BUFFER_FT)}"),
    "nearest_150": (f"SELECT bbl_chr, segment_id, physical_id, round(dist_ft, 6) AS dist_ft FROM "
                    f"({_nearest(_ALL_NEAR)})"),
    "bbl_segment_physical": "SELECT * FROM bsp",
    "bbl_to_physical": "SELECT * FROM b2p",
    "bbl_to_segment": "SELECT * FROM b2s",
    "bbl_summary": (f"SELECT (SELECT {cnt()} FROM b2p) AS bbl_physical_pairs, (SELECT {ndna('bbl_chr')} FROM b2p) "
                    f"AS bbls_matched, (SELECT {ndna('physical_id')} FROM b2p) AS physical_ids_with_bbls, "
                    f"(SELECT {cnt()} FROM r4) AS bbls_unmatched"),
    "match_rate": ("SELECT source, n_pairs, CAST((n_pairs * 2000 + total) // (2 * total) AS DOUBLE) / 10.0 AS pct FROM "
                   f"(SELECT source, n_pairs, sum(n_pairs) OVER () AS total FROM (SELECT source, {cnt()} AS n_pairs "
                   "FROM b2p GROUP BY source))"),
    "bin_to_bbl": "SELECT * FROM bin2bbl",
    "bin_to_physical": "SELECT * FROM bin2p",
    "bin_summary": (f"SELECT {cnt()} AS bin_physical_pairs, {ndna('bin')} AS distinct_bins, "
                    f"{ndna('physical_id')} AS physical_ids_with_bins FROM bin2p"),
    "address_list": "SELECT * FROM addr",
    "address_summary": f"SELECT {cnt()} AS total_addresses, {ndna('physical_id')} AS blocks_with_addresses FROM addr",
    "within_50_lonlat": (f"SELECT bbl_chr, segment_id, physical_id, CAST(floor(min(round(dist_ft, 2)) / 10) AS BIGINT) AS tens_ft FROM "
                         f"({_pairs_within('pk', BUFFER_FT)}) WHERE round(dist_ft, 2) < 49.9 AND (round(dist_ft, 2) = 0 OR round(dist_ft, 2) > 0.1) "
                         "GROUP BY bbl_chr, segment_id, physical_id"),
    "csv_round_trip": "SELECT * FROM fx_pad_addr",
    "addr_per_block": "SELECT * FROM apb",
    "addr_per_block_summary": six_number("n_addresses", "apb"),
    "master_full": "SELECT * FROM mf",
    "master_full_summary": (f"SELECT {cnt()} AS total_blocks, {count_if('n_bbls > 0')} AS blocks_with_bbls, "
                            f"{count_if('n_bins > 0')} AS blocks_with_bins, {count_if('n_addresses > 0')} AS "
                            "blocks_with_addresses, quantile_cont(n_bbls, 0.5) AS median_bbls, "
                            "quantile_cont(n_bins, 0.5) AS median_bins, quantile_cont(n_addresses, 0.5) AS "
                            "median_addresses FROM mf"),
    "unmatched": "SELECT * FROM um",
    "unmatched_by_land_use": (f"SELECT land_use, {cnt()} AS n FROM um GROUP BY land_use "
                              "ORDER BY n DESC, land_use ASC NULLS LAST LIMIT 10"),
}


def _needed(body: str) -> list[str]:
    names = [n for n, _ in CTES]
    need: set[str] = set()
    stack = [body]
    while stack:
        text = stack.pop()
        for n, b in CTES:
            if n not in need and re.search(rf"\b{re.escape(n)}\b", text):
                need.add(n)
                stack.append(b)
    return [n for n in names if n in need]


def build(name: str) -> str:
    body = QUERIES[name]
    defs = dict(CTES)
    need = _needed(body)
    if not need:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({defs[n]})" for n in need) + "\n" + body


def oracle_sql() -> dict[str, str]:
    return {name: build(name) for name in QUERIES}

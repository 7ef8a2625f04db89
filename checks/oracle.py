"""The registered queries in plain SQL, written from the rules' definitions.

Conditions are stated as nested EXISTS / NOT IN tests and recursion, not in the
shape of the Spark jobs.
"""

from __future__ import annotations

from checks.queries import ROUTING
from checks.star_mapping import oracle_ctes
from tripwire.operators.outbox import Routing
from tripwire.plans.rules import CATALOGUE
from tripwire.plans.templates import CLOSING, NOUN_MANY, NOUN_ONE, TEMPLATES


def _listed(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


# Fixed values, stated here on their own: part groups with short lead times, and with stock below zero.
SHORT_LEAD_GROUPS = [
    "002", "003", "004", "005", "006", "007", "008", "009", "010", "011", "012", "013", "014", "015", "016", "017", "018",
    "019", "020", "021", "050", "085", "086", "087", "088", "090", "093", "094", "095", "096", "097", "099", "100", "107",
    "120", "200", "203", "224", "226", "228", "230", "232", "237", "240", "244", "385", "387", "393", "395", "396", "398", "990",
]
NEGATIVE_STOCK_GROUPS = ["002", "004", "085", "094", "097", "100", "120", "226", "230"]

LIVE = "n.ord_status not in ('C','F','I')"
NO_PROJECT = "n.prj_no is null"

# rule -> (tables besides the changed one, condition on the changed row n)
CONDITIONS: dict[int, tuple[list[str], str]] = {
    1: (["order_header", "order_line"], """n.inv_orig_inv_no = 0
 and (select ord_bo_accptd from erp_order_header h where h.ord_no = n.ord_no) = false
 and exists (select 1 from erp_order_line l where l.ord_no = n.ord_no and l.orl_quantity - l.orl_qty_ready <> 0)"""),
    2: ([], "n.inv_status = 'F' and n.inv_ship_amnt = 0 and n.inv_ship_term = 0 and n.inv_no <> 0 and n.inv_subtotal >= 0"),
    3: ([], "n.inv_inv_email_sent = false and n.inv_no <> 0 and n.inv_subtotal >= 0"),
    4: ([], "n.old_inl_status <> 'A' and n.inl_status = 'A'"),
    5: (["planning_lot_quantity"], """n.old_inl_status <> 'F' and n.inl_status = 'F' and n.orl_id <> 0 and n.inl_ship_qty <> 0
 and n.orl_id in (select orl_id from erp_planning_lot_quantity where plq_adj_flag = false)"""),
    6: (["order_line"], f"""{NO_PROJECT} and {LIVE} and n.ord_type not in (9, 10)
 and exists (select 1 from erp_order_line l where l.ord_no = n.ord_no and l.orl_quantity = 0 and l.prt_no <> '')"""),
    7: (["order_line"], f"""{NO_PROJECT} and {LIVE} and n.ord_type = 9
 and n.ord_no in (select ord_no from erp_order_line where prt_no <> '')
 and n.ord_no not in (select ord_no from erp_order_line where prt_no <> '' and orl_quantity <> 0 and ord_no is not null)"""),
    8: (["order_line"], f"""{NO_PROJECT} and n.ord_status <> 'E' and n.old_ord_status <> 'E' and n.ord_type <> 9 and n.ord_type <> 10
 and exists (select 1 from erp_order_line l where l.ord_no = n.ord_no and l.orl_quantity <> l.orl_reserved_qty
  and (l.orl_quantity <> l.orl_ship_qty or l.orl_quantity <> l.orl_qty_ready + l.orl_ship_qty + l.orl_reserved_qty
   or l.orl_quantity <> l.orl_ship_qty + l.orl_reserved_qty))"""),
    9: ([], f"{NO_PROJECT} and n.old_ord_status in ('A','B') and n.ord_status = 'C'"),
    10: (["order_line"], f"""{NO_PROJECT} and (n.ord_status = 'A' or (n.ord_status = 'B' and n.ord_bo_accptd <> true))
 and n.ord_no in (select ord_no from erp_order_line where orl_req_dt is not null group by ord_no having count(distinct orl_req_dt) > 1)"""),
    11: (["order_line", "part"], f"""{NO_PROJECT}
 and n.ord_no in (select ord_no from erp_order_line where prt_no in
  (select prt_no from erp_part where prt_sort ilike 'ASV%' and prt_sort <> 'ASV Tabl' and prt_type = 'F'))
 and n.ord_no not in (select ord_no from erp_order_line where prt_no = 'AE750' and ord_no is not null)"""),
    12: ([], f"{NO_PROJECT} and n.ord_pmt_term = 4 and n.ord_status in ('A','B','D','E') and n.ord_type = 1 and n.ord_pkg_cost = 0"),
    13: (["order_line"], f"""{NO_PROJECT} and {LIVE} and (n.ord_no, n.cli_id) in (
  select (h.ord_no, h.cli_id) from erp_order_line l join erp_order_header h on h.ord_no = l.ord_no
  join (select h2.cli_id, l2.prt_no, l2.ord_no from erp_order_line l2 join erp_order_header h2 on h2.ord_no = l2.ord_no
   where h2.ord_type = 9 and h2.ord_status not in ('C','F','I') and l2.prt_no <> '') b
   on b.cli_id = h.cli_id and b.prt_no = l.prt_no and b.ord_no <> l.ord_no
  where h.ord_type = 1)"""),
    14: (["order_line", "part", "part_group"], f"""{NO_PROJECT} and exists (
  select 1 from erp_order_header h join erp_order_line l on l.ord_id = h.ord_id join erp_part p on p.prt_id = l.prt_id
  join erp_part_group g on g.pgr_id = p.pgr_id
  where h.ord_no = n.ord_no and l.orl_req_dt < h.ord_date + 14 and h.ord_status not in ('C','F','I')
   and g.pgr_no not in ({_listed(SHORT_LEAD_GROUPS)}))"""),
    15: ([], f"""{NO_PROJECT} and n.ord_cli_ord_no <> '' and n.ord_status <> 'C' and exists (
  select 1 from erp_order_header h where h.ord_no <> n.ord_no and h.inv_cli_id = n.inv_cli_id and h.ord_cli_ord_no = n.ord_cli_ord_no)"""),
    16: ([], "n.old_ord_type <> 9 and n.ord_type = 9"),
    17: ([], "n.old_ord_type <> 10 and n.ord_type = 10"),
    18: ([], "n.old_ord_status in ('D','E') and n.ord_status in ('A','B') and n.ord_date <> cast(n.commit_ts as date)"),
    19: (["order_line", "part_kit"], f"""{LIVE} and n.ord_no in (
  select l.ord_no from erp_order_line l join erp_part_kit k on k.pkt_master_prt_id = l.prt_id
  left join (select distinct orl_kitmaster_id, prt_id from erp_order_line) c on c.orl_kitmaster_id = l.orl_id and c.prt_id = k.prt_id
  where l.orl_kitmaster_id = 0 and c.orl_kitmaster_id is null
   and l.orl_id not in (select orl_kitmaster_id from erp_order_line where prt_id is null and orl_kitmaster_id is not null))"""),
    20: (["order_line", "part_kit"], f"""{LIVE} and n.ord_no in (
  select l.ord_no from erp_order_line l join erp_part_kit k on k.prt_id = l.prt_id
  join erp_order_line p on p.ord_no = l.ord_no and p.orl_id = l.orl_kitmaster_id
  join erp_order_line m on m.ord_no = l.ord_no and m.prt_id = k.pkt_master_prt_id
  where k.pkt_qty * p.orl_quantity <> l.orl_quantity)"""),
    21: (["order_line", "part"], """lower(n.car_name) like '%ups%' and exists (
  select 1 from erp_part p join erp_order_line l on l.prt_no = p.prt_no where p.prt_usr_flag1 and l.ord_no = n.ord_no)"""),
    22: ([], "n.cli_bo_accptd and (n.cli_creation_dt = cast(n.commit_ts as date) or n.old_cli_active <> n.cli_active)"),
    23: ([], f"n.prt_type = 'A' and n.ptn_qty_after < 0 and n.pgr_no not in ({_listed(NEGATIVE_STOCK_GROUPS)})"),
    24: (["bill_of_materials_mat", "part_quantity", "planning_lot_quantity"], """n.pld_lvl <> 0
 and n.prt_id in (select prt_master_id from erp_bill_of_materials_mat) and n.pld_qty_res = 0
 and (select pqt_real_qty from erp_part_quantity q where q.prt_id = n.prt_id) >=
  (select sum(pld_qty_res) from erp_planning_lot_detailed d where d.prt_id = n.prt_id and d.pld_adj_flag = false) + n.pld_qty_for
 and (select plq_adj_flag from erp_planning_lot_quantity q where q.plq_id = n.plq_id) = false"""),
    25: ([], """n.pld_lvl = 0 and coalesce(n.plq_lot_no not in (
  select plq_lot_no from erp_planning_lot_detailed where pld_lvl > 0 and plq_lot_no is not null), true)"""),
    26: ([], "n.pul_rcvd_qty <> n.old_pul_rcvd_qty"),
    27: ([], "n.pul_rcvd_qty > n.pul_prch_qty"),
    28: (["purchase_order_header", "part", "part_supplier"], """n.prt_no <> '' and (
  select h.sup_id from erp_purchase_order_header h where h.puh_id = n.puh_id and exists (
   select 1 from erp_part_supplier s join erp_part p on p.prt_id = s.prt_id
   where s.sup_id = h.sup_id and p.prt_no = n.prt_no)) is null"""),
    29: ([], "n.pqt_real_qty <> n.old_pqt_real_qty"),
}


def _rule_body(table: str, number: int, alert: str, ref: str, ops: tuple[str, ...]) -> str:
    return f"""select {number} rule_no, '{alert}' alert, '{ref}' ref_type, cast(n.{ref} as varchar) reference,
 n.app_name, n.commit_ts, n.change_seq from erp_{table} n
 where n.op in ({_listed(list(ops))}) and {CONDITIONS[number][1]}"""


def _rules(*alerts: str, tables: list[str] | None = None) -> tuple[list[str], str]:
    """The mapped tables needed and the SQL of the rules raised by ``tables`` or named."""
    needed: list[str] = []
    bodies: list[str] = []
    for table, (rules, _) in CATALOGUE.items():
        for r in rules:
            if (tables and table in tables) or r.alert in alerts:
                needed += [table, *CONDITIONS[r.number][0]]
                bodies.append(_rule_body(table, r.number, r.alert, r.ref, r.ops))
    return list(dict.fromkeys(needed)), "\nunion all ".join(bodies)


def _with(names: list[str], *parts: str, recursive: bool = False) -> str:
    """A statement over the named mapped tables; all parts but the last are CTEs."""
    head = oracle_ctes(*names)
    if recursive:
        head = head.replace("with ", "with recursive ", 1)
    return ",\n".join([head, *parts[:-1]]) + "\n" + parts[-1]


def _read_session(source: str) -> str:
    return f"""select time_stamp, alert, ref_type, reference, change_seq,
 case when regexp_matches(app_name, 'aSIGMWIN\\.EXE u.* m') then regexp_extract(app_name, 'aSIGMWIN\\.EXE u(.*) m', 1) end user_name,
 case when regexp_matches(app_name, ' w.*$') then regexp_extract(app_name, ' w(.*)$', 1) end station from {source}"""


def _greedy(points: str, key: list[str]) -> list[str]:
    """CTEs: ``accepted`` has the accepted times of ``points`` (key columns and ts)."""
    keys = ", ".join(key)
    own = ", ".join(f"a.{k}" for k in key)
    match = " and ".join(f"a.{k} = p.{k}" for k in key)
    return [
        f"accepted as (select {keys}, min(ts) ts from {points} group by {keys} union all "
        f"select {own}, min(p.ts) from accepted a join {points} p on {match} and p.ts >= a.ts + interval 1 hour group by {own})"
    ]


KEY5 = ["alert", "ref_type", "reference", "user_name", "station"]

CANDIDATES = "cand as (" + _read_session(
    "(select *, commit_ts time_stamp from erp_alert_candidates)"
) + ")"


def _flag(condition: str) -> str:
    return f"coalesce(bool_or({condition}), false)"


ORDER_FACTS = f"""select l.ord_no, count(*) filter (where l.prt_no <> '') named_lines,
 count(*) filter (where l.prt_no <> '' and l.orl_quantity = 0) named_zero_lines,
 count(distinct l.orl_req_dt) > 1 dates_differ,
 {_flag('l.orl_quantity - l.orl_qty_ready <> 0')} has_unready_line,
 {_flag("l.orl_quantity = 0 and l.prt_no <> ''")} has_zero_line,
 {_flag('l.orl_quantity <> l.orl_reserved_qty and (l.orl_quantity <> l.orl_ship_qty or l.orl_quantity <> l.orl_qty_ready + l.orl_ship_qty + l.orl_reserved_qty or l.orl_quantity <> l.orl_ship_qty + l.orl_reserved_qty)')} has_unreserved_line,
 {_flag("l.prt_no = 'AE750'")} has_accessory,
 {_flag("l.prt_no in (select prt_no from erp_part where prt_sort ilike 'ASV%' and prt_sort <> 'ASV Tabl' and prt_type = 'F')")} needs_accessory,
 {_flag('l.prt_no in (select prt_no from erp_part where prt_usr_flag1)')} needs_truck
 from erp_order_line l group by l.ord_no"""

# Each version of a line with the positions of the log between which it held.
LINE_COLUMNS = "orl_id, ord_no, prt_no, orl_quantity, orl_reserved_qty, orl_ship_qty, orl_qty_ready, orl_req_dt"
LINE_VERSIONS = f"""line_versions as (
 select {LINE_COLUMNS}, -1 valid_from, 9000000000000000000 valid_to from erp_order_line where orl_id not in (select orl_id from erp_line_feed)
 union all select orl_id, ord_no, old_prt_no, old_orl_quantity, orl_reserved_qty, orl_ship_qty, orl_qty_ready, old_orl_req_dt, -1, change_seq
  from erp_line_feed where op <> 'INSERT'
 union all select {LINE_COLUMNS}, change_seq, 9000000000000000000 from erp_line_feed where op <> 'DELETE')"""
ASOF_FACTS = """asked as (select h.* exclude (change_seq), h.change_seq * 1000 + p.n change_seq from erp_order_header h, (values (1), (450), (900)) p(n)),
held as (select n.change_seq, bool_or(l.orl_quantity = 0 and l.prt_no <> '') zero, count(*) filter (where l.prt_no <> '') named,
 count(*) filter (where l.prt_no <> '' and l.orl_quantity = 0) named_zero, count(distinct l.orl_req_dt) dates,
 bool_or(l.orl_quantity <> l.orl_reserved_qty and (l.orl_quantity <> l.orl_ship_qty or l.orl_quantity <> l.orl_qty_ready + l.orl_ship_qty + l.orl_reserved_qty
  or l.orl_quantity <> l.orl_ship_qty + l.orl_reserved_qty)) unreserved, bool_or(l.prt_no = 'AE750') accessory,
 bool_or(p.prt_sort ilike 'ASV%' and p.prt_sort <> 'ASV Tabl' and p.prt_type = 'F') asv, bool_or(p.prt_usr_flag1) truck
 from asked n join line_versions l on l.ord_no = n.ord_no and l.valid_from <= n.change_seq and n.change_seq < l.valid_to
 left join erp_part p on p.prt_no = l.prt_no group by n.change_seq)"""
ASOF_CONDITIONS = {
    6: f"{NO_PROJECT} and {LIVE} and n.ord_type not in (9, 10) and f.zero",
    7: f"{NO_PROJECT} and {LIVE} and n.ord_type = 9 and f.named > 0 and f.named = f.named_zero",
    8: f"{NO_PROJECT} and n.ord_status <> 'E' and n.old_ord_status <> 'E' and n.ord_type not in (9, 10) and f.unreserved",
    10: f"{NO_PROJECT} and (n.ord_status = 'A' or (n.ord_status = 'B' and n.ord_bo_accptd <> true)) and f.dates > 1",
    11: f"{NO_PROJECT} and f.asv and not f.accessory",
    21: "lower(n.car_name) like '%ups%' and f.truck",
}

KIT_PARENTS = """select distinct l.ord_no, l.orl_sort_idx, l.prt_no, l.orl_id from erp_order_line l
 where l.prt_id in (select pkt_master_prt_id from erp_part_kit)"""
KIT_CHILDREN = """select distinct l.ord_no, l.orl_kitmaster_id parent_id, l.orl_sort_idx, l.prt_no
 from erp_order_line l join kit_parents p on p.ord_no = l.ord_no and p.orl_id = l.orl_kitmaster_id"""
KIT_ERRORS = """select distinct l.ord_no, l.orl_kitmaster_id parent_id, l.orl_sort_idx, l.prt_no,
 cast(round(k.pkt_qty * p.orl_quantity) as bigint) fixed_qty
 from erp_order_line l join erp_order_line p on p.ord_no = l.ord_no and p.orl_id = l.orl_kitmaster_id
 join erp_part_kit k on k.prt_id = l.prt_id and k.pkt_master_prt_id = p.prt_id
 where k.pkt_qty * p.orl_quantity <> l.orl_quantity"""
BLANKETS = """select o.ord_no, b.prt_no, b.ord_no blanket_ord_no
 from (select distinct h.ord_no, l.prt_no, c.cli_no from erp_order_header h join erp_client c on c.cli_id = h.cli_id
  join erp_order_line l on l.ord_no = h.ord_no) o
 join erp_blanket_orders b on b.cli_no = o.cli_no and b.prt_no = o.prt_no"""


def _report(lines: str, line_text: str, kit_text: str, sep: str) -> str:
    """The nested report as text: kits of an order in line order, lines within."""
    return f"""select ord_no, string_agg({kit_text}, '{sep}' order by idx, orl_id) listing, count(*) parents from (
 select p.ord_no, p.orl_sort_idx idx, p.orl_id, p.prt_no, {lines} body
 from kit_parents p left join kit_lines k on k.ord_no = p.ord_no and k.parent_id = p.orl_id
 group by p.ord_no, p.orl_sort_idx, p.orl_id, p.prt_no) group by ord_no""".replace("LINE", line_text)


def _short_report(line_text: str) -> str:
    return _report(
        "coalesce(string_agg(LINE, ',' order by k.orl_sort_idx, k.prt_no), '')", line_text,
        "concat(idx, '/', prt_no, '[', body, ']')", " ",
    )


def _long_report(line_text: str) -> str:
    return _report(
        "coalesce(string_agg(chr(10) || LINE, '' order by k.orl_sort_idx, k.prt_no), '')", line_text,
        "concat('Kit line ', idx, ', part ', prt_no, body)", "' || chr(10) || chr(10) || '",
    )


# ``||`` is null for a kit without lines, which then lists none.
COMPONENT_LINE = "'  line ' || k.orl_sort_idx || ', part ' || k.prt_no"
MULTIPLIER_LINE = "'  line ' || k.orl_sort_idx || ', part ' || k.prt_no || ': suggested quantity ' || k.fixed_qty"
BLANKET_LISTING = """select ord_no, string_agg(concat('Part ', prt_no, ' in blanket order ', blanket_ord_no), chr(10) order by prt_no, blanket_ord_no) listing
 from blankets group by ord_no"""

# CTEs that every message query shares; each needs the mapped tables below.
REPORT_TABLES = ["order_line", "order_header", "client", "part_kit", "blanket_orders"]
REPORT_CTES = [
    f"kit_parents as ({KIT_PARENTS})",
    f"blankets as ({BLANKETS})",
    f"kit_lines_present as ({KIT_CHILDREN})",
    f"kit_lines_off as ({KIT_ERRORS})",
    f"listing_blankets as ({BLANKET_LISTING})",
    f"listing_components as ({_long_report(COMPONENT_LINE).replace('kit_lines', 'kit_lines_present')})",
    f"listing_multipliers as ({_long_report(MULTIPLIER_LINE).replace('kit_lines', 'kit_lines_off')})",
    """confirmed as (select ord_no from (select p.ord_no, row_number() over (partition by p.ord_no order by p.orl_sort_idx, p.orl_id) place,
 exists (select 1 from kit_lines_off k where k.ord_no = p.ord_no and k.parent_id = p.orl_id) off from kit_parents p) where place = 1 and off)""",
]

CONTEXT_TABLES = [
    "order_header", "order_line", "client", "invoicing", "part_transaction", "purchase_order_header",
    "purchase_order_line", "supplier",
]
ENRICHED = """enriched as (select a.*,
 case ref_type when 'ord_no' then try_cast(reference as bigint)
  when 'orl_id' then (select l.ord_no from erp_order_line l where l.orl_id = try_cast(a.reference as bigint))
  when 'inv_no' then (select i.ord_no from erp_invoicing i where i.inv_no = try_cast(a.reference as bigint) and i.inv_no <> 0)
  when 'inv_pckslp_no' then (select i.ord_no from erp_invoicing i where i.inv_pckslp_no = try_cast(a.reference as bigint)) end ord_no,
 c.cli_name1 client_name, coalesce(t.prt_no, pl.prt_no) part_no, t.ptn_desc description, ph.puh_no, ph.puh_reference po_reference,
 s.sup_name1 supplier_name, ph.usr_no creator
 from alerts a
 left join erp_order_header h on a.ref_type = 'ord_no' and h.ord_no = try_cast(a.reference as bigint)
 left join erp_client c on c.cli_id = h.cli_id
 left join erp_part_transaction t on a.ref_type = 'ptn_id' and t.ptn_id = try_cast(a.reference as bigint)
 left join erp_purchase_order_line pl on a.ref_type = 'pul_id' and pl.pul_id = try_cast(a.reference as bigint)
 left join erp_purchase_order_header ph on ph.puh_id = pl.puh_id
 left join erp_supplier s on s.sup_id = ph.sup_id)"""

HANDLED = _listed([t.alert for t in TEMPLATES])
GATED = f"""gated as (select *, case when alert not in ({HANDLED}) then 'unhandled'
 when alert = 'RECEPTION' and coalesce(po_reference, '') not like '%ALERT%' then 'gated'
 when alert = 'MISSING SUPPLIER' and part_no = 'SPECIAL' then 'gated'
 when alert = 'COMPONENT MULTIPLIER' and ord_no not in (select ord_no from confirmed) then 'gated'
 else 'accepted' end disposition from enriched)"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _filled(text: str) -> str:
    """A template as a chain of replacements."""
    out = _text(text)
    for name, column in {
        "ref": "reference", "user": "user_name", "client": "client_name", "order": "ord_no", "part": "part_no",
        "description": "description", "po": "puh_no", "supplier": "supplier_name", "list": "listing", "noun": "noun",
    }.items():
        if f"{{{name}}}" in text:
            out = f"replace({out}, '{{{name}}}', coalesce(cast({column} as varchar), ''))"
    return out


def _chosen(column: str, mapping: dict[str, str], default: str) -> str:
    whens = " ".join(f"when {_text(k)} then {_text(v)}" for k, v in mapping.items())
    return f"case {column} {whens} else {default} end" if whens else default


def _messages(routing: Routing = ROUTING) -> list[str]:
    """CTE and statement: the messages of the accepted rows of ``gated``."""
    def addresses(roles: tuple[str, ...]) -> list[str]:
        return [routing.addresses.get(r, r) for r in roles]

    def by_alert(value) -> str:
        return "case alert " + " ".join(f"when {_text(t.alert)} then {value(t)}" for t in TEMPLATES) + " end"

    def to(t) -> str:
        if routing.dev:
            return _text(routing.admin)
        default = _text(", ".join(addresses(t.to)))
        if t.route == "user":
            return _chosen("user_name", routing.users, default)
        if t.route == "creator":
            return _chosen("creator", routing.creators, default)
        return default

    def cc(t) -> str:
        if routing.dev:
            return _text(routing.admin)
        fixed = _text(", ".join(addresses(t.cc)))
        if t.route != "creator":
            return fixed
        found = ", ".join(
            f"case when po_reference like {_text('%' + k + '%')} then {_text(v)} end" for k, v in routing.initials.items()
        )
        return f"concat_ws(', ', {found})"

    admin = _text(routing.addresses.get(routing.admin, routing.admin))
    return [
        f"""listed as (select g.*, case g.alert when 'EXISTING BLANKET' then b.listing when 'MISSING COMPONENT' then k.listing
 when 'COMPONENT MULTIPLIER' then m.listing end listing,
 case when g.alert = 'COMPONENT MULTIPLIER' then case when m.parents = 1 then {_text(NOUN_ONE)} else {_text(NOUN_MANY)} end end noun
 from gated g left join listing_blankets b on b.ord_no = g.ord_no left join listing_components k on k.ord_no = g.ord_no
 left join listing_multipliers m on m.ord_no = g.ord_no where g.disposition = 'accepted')""",
        f"""mail as (select time_stamp, alert, ref_type, reference, user_name, station,
 {_text(routing.sender)} from_header, {by_alert(to)} to_header, {by_alert(cc)} cc_header,
 {by_alert(lambda t: _filled(t.subject))} subject, {by_alert(lambda t: _filled(t.body + CLOSING))} body from listed)""",
        f"""select *, concat_ws(';', replace(to_header, ', ', ';'), nullif(replace(cc_header, ', ', ';'), ''), {admin}) recipients from mail""",
    ]


def _outbox(*alerts: str, routing: Routing = ROUTING) -> str:
    needed, body = _rules(*alerts)
    return _with(
        [*dict.fromkeys([*needed, *CONTEXT_TABLES, *REPORT_TABLES])],
        f"raised as ({body})", "alerts as (" + _read_session("(select *, commit_ts time_stamp from raised)") + ")",
        ENRICHED, *REPORT_CTES, GATED, *_messages(routing),
    )


def _gate(alert: str) -> str:
    needed, body = _rules(alert)
    return _with(
        [*dict.fromkeys([*needed, *CONTEXT_TABLES, *REPORT_TABLES])],
        f"raised as ({body})", "alerts as (" + _read_session("(select *, commit_ts time_stamp from raised)") + ")",
        ENRICHED, *REPORT_CTES, GATED, "select reference, change_seq, disposition from gated",
    )


def _list_lines() -> str:
    """The numbered lines of the three kinds of list, for the orders whose alert passes its gate."""
    alerts = ["EXISTING BLANKET", "MISSING COMPONENT", "COMPONENT MULTIPLIER"]
    needed, body = _rules(*alerts)

    def kit_rows(alert: str, lines: str, text: str) -> str:
        return f"""select '{alert}' alert, p.ord_no, p.orl_sort_idx a, p.orl_id b, null c, null d,
 concat('Kit line ', p.orl_sort_idx, ', part ', p.prt_no) text from kit_parents p
 union all select '{alert}', p.ord_no, p.orl_sort_idx, p.orl_id, k.orl_sort_idx, k.prt_no, {text}
 from kit_parents p join {lines} k on k.ord_no = p.ord_no and k.parent_id = p.orl_id"""

    return _with(
        [*dict.fromkeys([*needed, *CONTEXT_TABLES, *REPORT_TABLES])],
        f"raised as ({body})", "alerts as (" + _read_session("(select *, commit_ts time_stamp from raised)") + ")",
        ENRICHED, *REPORT_CTES, GATED,
        f"""kit_text as ({kit_rows('MISSING COMPONENT', 'kit_lines_present', COMPONENT_LINE)}
 union all {kit_rows('COMPONENT MULTIPLIER', 'kit_lines_off', MULTIPLIER_LINE)})""",
        """numbered as (select alert, ord_no, row_number() over (partition by alert, ord_no order by a, b, c nulls first, d nulls first, text) line_no, text from kit_text
 union all select 'EXISTING BLANKET', ord_no, row_number() over (partition by ord_no order by prt_no, blanket_ord_no),
 concat('Part ', prt_no, ' in blanket order ', blanket_ord_no) from blankets)""",
        "select n.* from numbered n where exists (select 1 from gated g where g.disposition = 'accepted' and g.alert = n.alert and g.ord_no = n.ord_no)",
    )


def _repeated_keys() -> str:
    keys = [("order_header", "ord_no"), ("order_line", "orl_id"), ("client", "cli_id"), ("part_transaction", "ptn_id"),
            ("purchase_order_line", "pul_id"), ("purchase_order_header", "puh_id"), ("supplier", "sup_id")]
    return _with([t for t, _ in keys], "\nunion all ".join(
        f"""select '{t}' "table", '{k}' "key", count(*) repeated from (select {k} from erp_{t} where {k} is not null group by {k} having count(*) > 1)"""
        for t, k in keys))


def _pipeline(*last: str) -> str:
    """All alerts, suppressed, enriched and gated, and a statement over them."""
    needed, body = _rules(tables=list(CATALOGUE))
    keys = ", ".join(KEY5)
    match = " and ".join(f"r.{k} = a.{k}" for k in KEY5)
    return _with(
        [*dict.fromkeys([*needed, *CONTEXT_TABLES, *REPORT_TABLES])],
        f"raised as materialized ({body})",
        "session as materialized (" + _read_session("(select *, commit_ts time_stamp from raised)") + ")",
        f"points as materialized (select distinct {keys}, time_stamp ts from session)",
        *_greedy("points", KEY5),
        f"judged as (select r.*, a.ts is not null as passed from session r left join accepted a on {match} and r.time_stamp = a.ts)",
        "alerts as materialized (select * exclude (passed) from judged where passed)",
        ENRICHED, *REPORT_CTES, GATED, *last, recursive=True,
    )


def _lookup(table: str, key: str, out: str, tables: list[str], value: str) -> str:
    return _with(
        [*dict.fromkeys([table, *tables])],
        f"select k.{key}, ({value}) {out} from (select distinct {key} from erp_{table}) k",
    )


def _header_lookup(column: str, out: str) -> str:
    return _lookup(
        "purchase_order_header", "puh_no", out, [],
        f"select h.{column} from erp_purchase_order_header h where h.puh_no = k.puh_no",
    )


def oracle_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for table, (rules, _) in CATALOGUE.items():
        for r in rules:
            needed, body = _rules(r.alert)
            found[f"r{r.number:02d}_{r.alert.lower().replace(' ', '_')}"] = _with(needed, body)
    needed, body = _rules(tables=["order_header"])
    found["order_alerts"] = _with(needed, body)
    needed, body = _rules(tables=list(CATALOGUE))
    found["all_alerts"] = _with(needed, body)

    found["order_facts"] = _with(["order_line", "part"], ORDER_FACTS)
    lines = [c for c in ("named_lines", "named_zero_lines", "dates_differ", "has_unready_line", "has_zero_line",
                         "has_unreserved_line", "has_accessory")]
    found["facts_incremental"] = _with(["order_line", "part"], f"facts as ({ORDER_FACTS})", f"select ord_no, {', '.join(lines)} from facts")
    asof = "\nunion all ".join(
        f"select {r.number} rule_no, '{r.alert}' alert, 'ord_no' ref_type, cast(n.ord_no as varchar) reference, n.app_name, n.commit_ts, "
        f"n.change_seq from asked n join held f on f.change_seq = n.change_seq where {ASOF_CONDITIONS[r.number]}"
        for r in CATALOGUE["order_header"][0] if r.number in ASOF_CONDITIONS)
    found["asof_order_alerts"] = _with(["order_header", "order_line", "line_feed", "part"], LINE_VERSIONS, ASOF_FACTS, asof)
    found["normalise_part"] = _with(["part"], "select * from erp_part")
    found["normalise_flags"] = """select o_orderkey, case when lower(trim(o_orderstatus)) in ('t', 'true') then true
 when lower(trim(o_orderstatus)) in ('f', 'false') then false end flag from orders"""
    kits = ["order_line", "part_kit"]
    found["kit_parents"] = _with(kits, KIT_PARENTS)
    found["kit_child_lines"] = _with(kits, f"kit_parents as ({KIT_PARENTS})", KIT_CHILDREN)
    found["kit_quantity_errors"] = _with(kits, KIT_ERRORS)
    needed, body = _rules("EXISTING BLANKET")
    blanket_tables = [*dict.fromkeys([*needed, "order_line", "order_header", "client", "blanket_orders"])]
    asked = "where ord_no in (select cast(reference as bigint) from raised)"
    found["existing_blankets"] = _with(
        blanket_tables, f"raised as ({body})", f"blankets as ({BLANKETS})", f"select * from blankets {asked}")
    report = "select ord_no, listing report from (%s)"
    found["missing_component_report"] = _with(
        kits, f"kit_parents as ({KIT_PARENTS})", f"kit_lines as ({KIT_CHILDREN})",
        report % _short_report("k.orl_sort_idx || ':' || k.prt_no"),
    )
    found["multiplier_report"] = _with(
        kits, f"kit_parents as ({KIT_PARENTS})", f"kit_lines as ({KIT_ERRORS})",
        report % _short_report("k.orl_sort_idx || ':' || k.prt_no || '=' || k.fixed_qty"),
    )
    found["lookup_order_blankets"] = _with(
        blanket_tables, f"raised as ({body})", f"blankets as ({BLANKETS})",
        f"select ord_no, listing from ({BLANKET_LISTING}) {asked}",
    )

    greedy = _with(
        ["alert_candidates"],
        "points as (select distinct alert, reference, commit_ts ts from erp_alert_candidates)",
        *_greedy("points", ["alert", "reference"]),
        """select c.change_seq, case when a.ts is null then 'duplicate' else 'accepted' end disposition
 from erp_alert_candidates c left join accepted a on a.alert = c.alert and a.reference = c.reference and a.ts = c.commit_ts""",
        recursive=True,
    )
    found["suppress_greedy"] = found["suppress_hot_alerts"] = greedy
    keys = ", ".join(KEY5)
    same = " and ".join(f"c.{k} = a.{k}" for k in KEY5)
    found["suppress_seeded"] = _with(
        ["alert_candidates", "prior_log"], CANDIDATES,
        f"""placed as (select c.*, exists (select 1 from erp_prior_log a where {same}
 and a.time_stamp + interval 1 hour > c.time_stamp and a.time_stamp < c.time_stamp) blocked from cand c)""",
        f"points as (select distinct {keys}, time_stamp ts from placed where not blocked)",
        *_greedy("points", KEY5),
        f"""select c.change_seq, case when c.user_name is null or c.station is null then 'accepted'
 when c.blocked or a.ts is null then 'duplicate' else 'accepted' end disposition from placed c left join accepted a on {same} and c.time_stamp = a.ts""",
        recursive=True,
    )
    found["duplicate_probe"] = _with(
        ["alert_candidates"], CANDIDATES,
        f"""select a.change_seq, exists (select 1 from cand c where {same}
 and c.time_stamp + interval 1 hour > a.time_stamp and c.time_stamp < a.time_stamp) is_duplicate from cand a""",
    )
    found["last_logged"] = _with(
        ["alert_candidates"], CANDIDATES, f"select {keys}, max(time_stamp) time_stamp from cand group by {keys}"
    )

    payloads = """payloads as (select change_seq, case change_seq % 40 when 7 then ref_type || ', ' || reference
 when 8 then ref_type || ', ' || reference || ', ' || alert || ', ' || app_name || ', more'
 else ref_type || ', ' || reference || ', ' || alert || ', ' || app_name end payload from erp_alert_candidates)"""
    found["payload_encode"] = _with(["alert_candidates"], payloads, "select change_seq, payload from payloads")
    found["payload_parse"] = _with(
        ["alert_candidates"], payloads,
        "fields as (select change_seq, string_split(payload, ', ') f from payloads)",
        "named as (select change_seq, f[1] ref_type, f[2] reference, f[3] alert, f[4] app_name, null time_stamp from fields)",
        "parsed as (" + _read_session("named") + ")",
        """select change_seq, ref_type, reference, alert, user_name, station,
 ref_type is null or reference is null or alert is null or user_name is null or station is null malformed from parsed""",
    )
    found["snapshot_diff"] = _with(
        ["order_header"],
        """select case when old_ord_status = 'C' then 'INSERT' when ord_status = 'C' then 'DELETE' else 'UPDATE' end op, ord_no,
 nullif(old_ord_status, 'C') old_status, nullif(ord_status, 'C') new_status from erp_order_header
 where (old_ord_status <> 'C' or ord_status <> 'C') and (old_ord_status <> ord_status or old_ord_type <> ord_type)""",
    )

    found["lookup_order_client"] = _lookup(
        "order_line", "ord_no", "cli_id", ["order_header"],
        "select h.cli_id from erp_order_header h where h.ord_no = k.ord_no",
    )
    found["lookup_line_order"] = _lookup(
        "planning_lot_quantity", "orl_id", "ord_no", ["order_line"],
        "select l.ord_no from erp_order_line l where l.orl_id = k.orl_id",
    )
    found["lookup_client_name"] = _lookup(
        "order_header", "cli_id", "client_name", ["client"],
        "select c.cli_name1 from erp_client c where c.cli_id = k.cli_id",
    )
    found["lookup_packing_slip_order"] = _lookup(
        "invoicing", "inv_pckslp_no", "ord_no", [],
        "select i.ord_no from erp_invoicing i where i.inv_pckslp_no = k.inv_pckslp_no",
    )
    found["lookup_invoice_order"] = _lookup(
        "invoicing", "inv_no", "ord_no", [],
        "select arg_min(i.ord_no, i.inv_pckslp_no) from erp_invoicing i where i.inv_no = k.inv_no",
    )
    found["lookup_transaction_part"] = _lookup(
        "part_transaction", "ptn_id", "part_no", [],
        "select t.prt_no from erp_part_transaction t where t.ptn_id = k.ptn_id",
    )
    found["lookup_transaction_text"] = _lookup(
        "part_transaction", "ptn_id", "description", [],
        "select t.ptn_desc from erp_part_transaction t where t.ptn_id = k.ptn_id",
    )
    found["lookup_lot_part"] = _lookup(
        "planning_lot_detailed", "plq_lot_no", "part_no", ["planning_lot_quantity"],
        "select arg_min(q.prt_no, q.plq_id) from erp_planning_lot_quantity q where q.plq_lot_no = k.plq_lot_no",
    )
    found["lookup_po_number"] = _lookup(
        "purchase_order_line", "pul_id", "puh_no", ["purchase_order_header"],
        "select h.puh_no from erp_purchase_order_line l join erp_purchase_order_header h on h.puh_id = l.puh_id where l.pul_id = k.pul_id",
    )
    found["lookup_po_line_part"] = _lookup(
        "purchase_order_line", "pul_id", "part_no", [],
        "select l.prt_no from erp_purchase_order_line l where l.pul_id = k.pul_id",
    )
    found["lookup_po_reference"] = _header_lookup("puh_reference", "po_reference")
    found["lookup_po_creator"] = _header_lookup("usr_no", "creator")
    found["lookup_po_supplier"] = _lookup(
        "purchase_order_header", "puh_no", "supplier_name", ["supplier"],
        "select s.sup_name1 from erp_purchase_order_header h join erp_supplier s on s.sup_id = h.sup_id where h.puh_no = k.puh_no",
    )

    needed, body = _rules("ORDER CANCELLED", "NEW BLANKET", "ZERO BANK FEES")
    found["enrich_order_context"] = _with(
        [*needed, "client"], f"raised as ({body})",
        """select r.alert, r.reference, h.ord_no, c.cli_name1 client_name from raised r
 left join erp_order_header h on h.ord_no = cast(r.reference as bigint) left join erp_client c on c.cli_id = h.cli_id""",
    )
    found["gate_multiplier"] = _gate("COMPONENT MULTIPLIER")
    found["gate_reception"] = _gate("RECEPTION")
    found["gate_missing_supplier"] = _gate("MISSING SUPPLIER")
    found["gate_unhandled"] = _gate("CHANGED PART QUANTITY")
    found["outbox_orders"] = _outbox("ZERO QUANTITY", "NOT RESERVED", "ORDER CANCELLED", "NEW BLANKET", "LINE DATES")
    found["outbox_invoices"] = _outbox("SHIPPING COST MISSING", "UNSENT INVOICE EMAIL")
    found["outbox_blankets"] = _outbox("EXISTING BLANKET")
    found["outbox_components"] = _outbox("MISSING COMPONENT")
    found["outbox_multipliers"] = _outbox("COMPONENT MULTIPLIER")
    found["outbox_purchasing"] = _outbox("RECEPTION", "MISSING SUPPLIER", "OVER RECEPTION")
    found["outbox_user_route"] = _outbox("UNCHECKED NEED CALCULATION")
    found["outbox_dev_override"] = _outbox("NEGATIVE QUANTITY", routing=Routing(dev=True))
    found["outbox_lines"] = _list_lines()
    found["repeated_keys"] = _repeated_keys()
    found["read_changes"] = _with(["order_header"], """select change_seq, op, change_seq % 10 txn_id, ord_no, ord_bo_accptd,
 old_ord_status old_status, cast(ord_date as varchar) ord_date from erp_order_header""")
    found["read_payloads"] = _with(
        ["alert_candidates"], payloads.replace("select change_seq, case", "select change_seq, commit_ts, case"),
        "fields as (select change_seq, commit_ts, string_split(coalesce(payload, ''), ', ') f from payloads)",
        """named as (select change_seq, f[1] ref_type, f[2] reference, f[3] alert, f[4] app_name,
 case when change_seq % 50 <> 3 then commit_ts end time_stamp from fields)""",
        "parsed as (" + _read_session("named") + ")",
        """select time_stamp, ref_type, reference, alert, user_name, station, ref_type is null or reference is null
 or alert is null or user_name is null or station is null or time_stamp is null malformed from parsed""",
    )
    found["alert_log"] = _with(["alert_candidates"], CANDIDATES, f"select time_stamp, {keys} from cand")
    found["outbox_table"] = "select time_stamp, alert, reference, to_header, subject, body from (" + _outbox("SHIPPING COST MISSING") + ")"
    found["suppress_stream"] = _with(
        ["alert_candidates"], CANDIDATES, f"points as (select distinct {keys}, time_stamp ts from cand)",
        *_greedy("points", KEY5),
        f"""select c.change_seq, case when c.user_name is null or c.station is null or a.ts is not null then 'accepted'
 else 'duplicate' end disposition from cand c left join accepted a on {same} and c.time_stamp = a.ts""",
        recursive=True,
    )
    # The log of an alert as a list that each time is held against in turn: ten times the microseconds, plus the batch.
    found["suppress_out_of_order"] = _with(
        ["alert_candidates"], CANDIDATES,
        f"""points as (select distinct {keys}, change_seq % 3 batch, epoch_us(time_stamp) us from cand
 where user_name is not null and station is not null)""",
        f"""logs as (select {keys}, list_reduce(list([us * 10 + batch] order by batch, us), lambda log, x:
 case when len(list_filter(log, lambda y: y // 10 < x[1] // 10 and y // 10 > x[1] // 10 - 3600000000)) > 0 then log else log || x end,
 cast([] as bigint[])) log from points group by {keys})""",
        f"""select c.change_seq, case when c.user_name is null or c.station is null
 or list_contains(a.log, epoch_us(c.time_stamp) * 10 + c.change_seq % 3) then 'accepted' else 'duplicate' end disposition
 from cand c left join logs a on {same}""")
    found["pipeline_dispositions"] = _pipeline(
        """select time_stamp, alert, ref_type, reference, user_name, station, change_seq, disposition from gated
 union all select time_stamp, alert, ref_type, reference, user_name, station, change_seq, 'duplicate' from judged where not passed"""
    )
    found["pipeline_messages"] = _pipeline(*_messages())
    return found

"""The ERP tables, derived from the generated star-schema parquet tables.

One text per table serves both engines: Spark reads it with ``//`` written as
``div``; the SQL oracle reads it with ``TIMESTAMP_NTZ`` written as ``TIMESTAMP``.
``old_*`` columns hold the old row image; ``op``, ``commit_ts``, ``change_seq``
and ``app_name`` describe the change.

Tables that take a shuffle to derive are written. Most others hold the rows of
another table one by one and are views (``VIEWS``): written, each would be one
more copy of the lines or orders.
"""

from __future__ import annotations

from functools import reduce
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.functions.frames import written
from tripwire.sources.snapshots import normalise

RAW = ["customer", "supplier", "part", "orders", "lineitem", "events"]


def _session(seq: str) -> str:
    return (
        f"concat('C:/ERP/aSIGMWIN.EXE uUSR',{seq}%7,' mPC',{seq}%3,' wST ',{seq}%4) app_name"
    )


def _clock(seq: str) -> str:
    return (
        "cast(date'2024-01-15' as TIMESTAMP_NTZ)"
        f" + cast({seq}%86400 as int) * interval 1 second commit_ts"
    )


# name -> (tables it reads, query)
MAPPING: dict[str, tuple[list[str], str]] = {
    "erp_client": (["customer"], f"""
select c_custkey cli_id, concat('C',c_custkey) cli_no, c_name cli_name1, c_custkey%3=0 cli_bo_accptd,
 c_custkey%4<>0 cli_active, c_custkey%5<>0 old_cli_active,
 case when c_custkey%7=0 then date'2024-01-15' else date'2020-01-01' end cli_creation_dt,
 'UPDATE' op, c_custkey change_seq, {_clock('c_custkey')}, {_session('c_custkey')} from customer"""),
    "erp_order_header": (["orders"], f"""
select o_orderkey+1000000 ord_id, o_orderkey ord_no, o_custkey cli_id, o_custkey-o_custkey%5 inv_cli_id,
 substr(case o_orderstatus when 'F' then 'FCIF' when 'O' then 'ABDE' else 'ABAE' end, cast(o_orderkey%4+1 as int),1) ord_status,
 substr('ABDEABC', cast(o_orderkey%7+1 as int),1) old_ord_status,
 case o_orderkey%10 when 0 then 9 when 1 then 10 when 2 then 2 else 1 end ord_type,
 case when o_orderkey%100<50 then 1 else case o_orderkey%10 when 0 then 9 when 1 then 10 when 2 then 2 else 1 end end old_ord_type,
 cast(o_orderdate as date) ord_date, o_orderkey%3<>0 ord_bo_accptd, case when o_orderkey%13=0 then o_orderkey end prj_no,
 o_orderkey%7 ord_pmt_term, (o_orderkey%4)*25 ord_pkg_cost, case when o_orderkey%6=0 then '' else concat('PO',o_orderkey%200) end ord_cli_ord_no,
 case o_orderpriority when '1-URGENT' then 'UPS Express' when '2-HIGH' then 'ups ground' else 'Truck' end car_name,
 'UPDATE' op, o_orderkey change_seq,
 cast(cast(o_orderdate as date) + cast(o_orderkey%2 as int) as TIMESTAMP_NTZ) commit_ts, {_session('o_orderkey')} from orders"""),
    "erp_base_line": (["lineitem"], """
select l_orderkey*100+l_linenumber*10 orl_id, l_orderkey ord_no, l_linenumber*10 orl_sort_idx, min(l_partkey) prt_id, min(l_suppkey) sup_id,
 cast(case when l_orderkey%30=0 or (l_orderkey*10+l_linenumber)%29=0 then 0 else sum(l_quantity) end as bigint) q,
 cast(min(l_shipdate) as date) dt from lineitem group by l_orderkey,l_linenumber"""),
    "erp_part_kit": (["part"], """
select case when p_partkey%10 in (1,2) then p_partkey-p_partkey%10 else -1-p_partkey end pkt_master_prt_id, p_partkey prt_id,
 cast(p_partkey%10+1 as int) pkt_qty from part"""),
    "erp_lines0": (["erp_base_line", "erp_part_kit"], """
select orl_id, ord_no, orl_sort_idx, prt_id, q, dt, cast(0 as bigint) km from erp_base_line
 union all select b.orl_id+k.prt_id%10, b.ord_no, b.orl_sort_idx+k.prt_id%10, k.prt_id,
  b.q*k.pkt_qty + case when (b.orl_id+k.prt_id)%7=0 then 1 else 0 end, b.dt,
  case when (b.orl_id//10+k.prt_id)%4<>0 then b.orl_id else b.orl_id+5 end
 from erp_base_line b join erp_part_kit k on b.prt_id=k.pkt_master_prt_id"""),
    "erp_order_line": (["erp_lines0"], """
select orl_id, ord_no, ord_no+1000000 ord_id, orl_sort_idx, prt_id,
 case when (orl_id//10)%17=0 then '' when prt_id=7 then 'AE750' else rpad(concat('P',prt_id),15,' ') end prt_no, q orl_quantity,
 case when (ord_no)%3=0 and orl_id%4=0 then greatest(q-5,0) else q end orl_reserved_qty, 0 orl_ship_qty,
 case when orl_id%5=0 and ord_no%2=0 then 0 else q end orl_qty_ready,
 case when orl_id%19=0 then null when ord_no%3=1 then date'2001-01-01' else dt end orl_req_dt, km orl_kitmaster_id from erp_lines0"""),
    "erp_part": (["part"], """
select p_partkey prt_id, case when p_partkey=7 then 'AE750' else rpad(concat('P',p_partkey),15,' ') end prt_no,
 case p_type when 'PROMO' then concat('asv ',p_size) when 'SMALL' then 'ASV Tabl' else p_type end prt_sort,
 case when p_partkey%2=0 then 'F' else 'A' end prt_type, p_partkey%8=0 prt_usr_flag1, p_partkey%60 pgr_id from part"""),
    "erp_part_group": (["erp_part"], """
select distinct pgr_id, lpad(cast(pgr_id as string),3,'0') pgr_no from erp_part"""),
    "erp_invoicing": (["orders"], f"""
select case when o_orderkey%9=0 then 0 else o_orderkey end inv_no, o_orderkey+5000000 inv_pckslp_no, o_orderkey ord_no,
 case when o_orderkey%8=0 then 1 else 0 end inv_orig_inv_no, case when o_orderkey%4<>1 then 'F' else 'A' end inv_status,
 o_orderkey%5 inv_ship_amnt, o_orderkey%3 inv_ship_term, case when o_orderkey%20=5 then -1 else 1 end*o_totalprice inv_subtotal,
 o_orderkey%7<>0 inv_inv_email_sent, case when o_orderkey%2=0 then 'INSERT' else 'UPDATE' end op,
 o_orderkey change_seq, {_clock('o_orderkey')}, {_session('o_orderkey')} from orders"""),
    "erp_planning_lot_quantity": (["erp_order_line"], """
select orl_id plq_id, orl_id, concat('L',ord_no) plq_lot_no, prt_no, (orl_id//10)%3=0 plq_adj_flag from erp_order_line"""),
    "erp_planning_lot_detailed": (["erp_order_line"], f"""
select orl_id pld_id, orl_id plq_id, concat('L',ord_no) plq_lot_no, prt_id, (orl_id//10)%3 pld_lvl,
 case when (orl_id//10)%4=0 then 0 else 1 end pld_qty_res, orl_quantity pld_qty_for, (orl_id//10)%7=0 pld_adj_flag,
 case when ord_no%2=0 then 'INSERT' else 'UPDATE' end op, orl_id change_seq, {_clock('orl_id')}, {_session('orl_id')} from erp_order_line"""),
    "erp_bill_of_materials_mat": (["erp_part_kit"], """
select distinct pkt_master_prt_id prt_master_id from erp_part_kit"""),
    "erp_part_quantity": (["part"], f"""
select p_partkey prt_id, p_size*2 pqt_real_qty, case when p_partkey%3=0 then p_size*2 else p_size end old_pqt_real_qty,
 'UPDATE' op, p_partkey change_seq, {_clock('p_partkey')}, {_session('p_partkey')} from part"""),
    "erp_part_supplier": (["lineitem"], """
select distinct l_partkey prt_id, case when l_linenumber<=4 then l_suppkey else l_suppkey+1000000 end sup_id from lineitem"""),
    "erp_supplier": (["supplier"], """
select s_suppkey sup_id, s_name sup_name1 from supplier"""),
    "erp_purchase_order_header": (["erp_base_line"], """
select ord_no+2000000 puh_id, ord_no+7000000 puh_no, case when ord_no%10=0 then null else min(sup_id) end sup_id, concat('U',ord_no%4) usr_no,
 case ord_no%4 when 0 then 'ALERT AA' when 1 then 'ALERT BB CC' when 2 then 'alert' else '' end puh_reference from erp_base_line group by ord_no"""),
    "erp_purchase_order_line": (["erp_base_line"], f"""
select orl_id pul_id, ord_no+2000000 puh_id,
 case when (orl_id//10)%23=0 then '' when (orl_id//10)%31=0 then 'SPECIAL' when prt_id=7 then 'AE750' else rpad(concat('P',prt_id),15,' ') end prt_no,
 q pul_prch_qty, q + (orl_id//10)%3 - 1 pul_rcvd_qty, q-1 old_pul_rcvd_qty,
 'UPDATE' op, orl_id change_seq, {_clock('orl_id')}, {_session('orl_id')} from erp_base_line"""),
    "erp_part_transaction": (["events"], f"""
select event_id ptn_id, concat('P',user_id) prt_no, concat(event_type,' move') ptn_desc, case when event_id%2=0 then 'A' else 'F' end prt_type,
 value-10 ptn_qty_after, lpad(cast(event_id%130 as string),3,'0') pgr_no,
 'INSERT' op, event_id change_seq, ts commit_ts, {_session('event_id')} from events"""),
    "erp_invoicing_line": (["erp_order_line"], f"""
select orl_id inl_id, ord_no+5000000 inv_pckslp_no, case when (orl_id//10)%23=0 then 0 else orl_id end orl_id,
 substr('AFN',cast((orl_id//10)%3+1 as int),1) inl_status, substr('AFN',cast((orl_id//10)%4%3+1 as int),1) old_inl_status,
 orl_qty_ready inl_ship_qty, 'UPDATE' op, orl_id change_seq, {_clock('orl_id')}, {_session('orl_id')} from erp_order_line"""),
    "erp_blanket_orders": (["erp_order_line", "erp_order_header", "erp_client"], """
select l.prt_no, l.ord_no, c.cli_no from erp_order_line l join erp_order_header h on h.ord_no=l.ord_no join erp_client c on c.cli_id=h.cli_id
 where h.ord_type=9 and h.ord_status not in ('C','F','I') and l.prt_no<>''"""),
    # Changes of order lines, of which the mapped lines are the outcome: some lines changed, some are new, some are gone.
    "erp_line_feed": (["erp_order_line"], """
select *, case when orl_quantity=0 then 5 else 0 end old_orl_quantity, case when (orl_id//10)%5=0 then 'AE750' else prt_no end old_prt_no,
 date'2002-02-02' old_orl_req_dt, 'UPDATE' op, ord_no*1000+100+orl_id%7*100 change_seq from erp_order_line where orl_id%3=0
 union all select *, orl_quantity, prt_no, orl_req_dt, 'INSERT', ord_no*1000+100+orl_id%7*100 from erp_order_line where orl_id%3=1 and (orl_id//10)%4=0
 union all select -orl_id, ord_no, ord_id, orl_sort_idx, prt_id, prt_no, orl_quantity, orl_reserved_qty, orl_ship_qty, orl_qty_ready,
  orl_req_dt, orl_kitmaster_id, 0, prt_no, date'2003-03-03', 'DELETE', ord_no*1000+100+orl_id%7*100
  from erp_order_line where orl_id%3=2 and (orl_id//10)%4=1"""),
    # Alerts that repeat, from the event stream; every fiftieth session text is unreadable.
    "erp_alert_candidates": (["events"], """
select event_id change_seq, ts commit_ts, event_type alert, 'user' ref_type, cast(user_id%10 as string) reference,
 case when event_id%50=49 then 'psql' else 'C:/ERP/aSIGMWIN.EXE uUSR1 mPC1 wST 1' end app_name from events"""),
    # A log that already holds some alerts when the candidates above arrive.
    "erp_prior_log": (["events"], """
select min(ts) time_stamp, event_type alert, 'user' ref_type, cast(user_id%10 as string) reference, 'USR1' user_name, 'ST 1' station
 from events group by event_type, user_id%10"""),
}


# Tables that are derived row by row, without an aggregate or a join; ``erp_lines0`` is read by one table only.
# Order headers and lots are written all the same: facts cut their scans to the keys of a batch.
VIEWS = {
    "erp_client", "erp_part_kit", "erp_lines0", "erp_part", "erp_invoicing", "erp_part_quantity",
    "erp_supplier", "erp_purchase_order_line", "erp_part_transaction", "erp_invoicing_line",
    "erp_line_feed", "erp_alert_candidates",
}

# Raw tables that are read by ranges of these columns. The lines derived from them then lie by order, so
# that what is asked of an order is combined before its shuffle.
IN_RANGES = {"erp_base_line": ("lineitem", ["l_orderkey", "l_linenumber"])}


def _needed(name: str) -> list[str]:
    """The mapped tables ``name`` reads, dependencies first, itself last."""
    order: list[str] = []
    for dep in MAPPING[name][0]:
        order += [t for t in (_needed(dep) if dep in MAPPING else []) if t not in order]
    return order + [name]


def oracle_ctes(*names: str) -> str:
    """A ``with`` clause that defines the named ERP tables over the raw tables."""
    order: list[str] = []
    for name in names:
        order += [t for t in _needed(f"erp_{name}") if t not in order]
    # Each mapped table once, however often it is read.
    ctes = ",\n".join(f"{t} as materialized ({MAPPING[t][1]})" for t in order)
    for table in names:
        ctes = ctes.replace("TIMESTAMP_NTZ", "TIMESTAMP")
    # part numbers compare without their padding, as after ``normalise``
    return "with " + ctes.replace("rpad(concat('P',prt_id),15,' ')", "concat('P',prt_id)").replace(
        "rpad(concat('P',p_partkey),15,' ')", "concat('P',p_partkey)"
    )


# Mapped tables of this process, by application, directory and name.
_BUILT: dict[tuple[str, str, str], DataFrame] = {}


class StarTables:
    """The mapped tables of one testdata directory.

    Each is derived once per application, on first use, and written unless it is
    a view, so that the rules scan tables as they would in a warehouse.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def flat(self, name: str) -> DataFrame:
        """A mapped table with its change columns."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _BUILT:
            deps, query = MAPPING[name]
            inputs = {d: self.flat(d) if d in MAPPING else self.raw(d) for d in deps}
            if name in IN_RANGES:
                dep, columns = IN_RANGES[name]
                inputs[dep] = inputs[dep].repartitionByRange(*columns)
            text = query.replace("//", " div ")
            for dep in inputs:
                text = _refer(text, dep)
            place = md5(self.sf_dir.encode()).hexdigest()
            found = self.spark.sql(text, **inputs)
            _BUILT[key] = found if name in VIEWS else written(found, f"{place}/{name}")
        return _BUILT[key]

    def snapshot(self, name: str) -> DataFrame:
        """A mapped table as the rules read it."""
        flat = self.flat(f"erp_{name}")
        meta = {"op", "commit_ts", "change_seq", "app_name"}
        keep = [c for c in flat.columns if c not in meta and not c.startswith("old_")]
        return normalise(flat.select(keep), name)

    def changes(self, name: str) -> DataFrame:
        """The change feed of a mapped table."""
        flat = normalise(self.flat(f"erp_{name}"), name)
        columns = self.snapshot(name).columns

        def before(c: str) -> Column:
            return F.col(f"old_{c}" if f"old_{c}" in flat.columns else c).alias(c)

        return flat.select(
            "op", "commit_ts", F.col("change_seq").cast("long").alias("change_seq"), "app_name",
            F.when(F.col("op") != "INSERT", F.struct(*[before(c) for c in columns])).alias("old"),
            F.struct(*columns).alias("new"),
        )


def _refer(text: str, table: str) -> str:
    """Turn each ``from``/``join`` of ``table`` into a DataFrame reference."""
    return reduce(
        lambda t, word: t.replace(f"{word} {table} ", f"{word} {{{table}}} ").replace(
            f"{word} {table}\n", f"{word} {{{table}}}\n"
        ),
        ("from", "join"),
        text + "\n",
    )

"""Warehouse tables derived from the TPC-H-like test tables.

The test data has orders, lineitem, customer, part, supplier, nation, region
and events.  The mapping below turns them into the policy warehouse the pull
reads (one fixed mapping, the same one the DuckDB oracle uses): an order is a
policy term, ``hh = o_custkey*4 + o_orderkey%4`` a household, a line item a
claim revision, an event a referral voucher.  Every table is read from the
input and grows with it, but for the code tables made of ``nation`` and
``region``, which are of fixed size there; the one extra e-mail row of the
do-not-contact list is made up.
"""

from __future__ import annotations

import datetime as dt
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.operators.skew import row_number_per_key

from canvass.session import shuffles_removed
from canvass.sources.warehouse import DOMAIN_TABLES, Warehouse

RAW_TABLES = ["orders", "lineitem", "customer", "part", "supplier", "nation", "region", "events"]
# The monthly in-force fact is stored one folder per report period, so the
# snapshot's date predicate prunes whole partitions.
PARTITIONED_BY = {"dw_data_inforce": "reportperiod"}
# The lists imported as they are, one file each.
LIST_SOURCES = ["A1", "A2", "B1", "B2", "C1", "C2", "D1", "D2"]
# Landing waves: every table only reads raw tables or tables of earlier waves.
LAND_WAVES = [
    ["policy_head", "claim_line", "dw_dim_insured", "dw_dim_breed", "dw_wp", "dw_dim_group",
     "dw_dim_provider", "dw_dim_origin", "dw_dim_paymentplan", "dw_dim_payment_type", "dw_dim_source",
     "dw_dim_zipcode", "dw_dim_coverage", "dw_dim_policy_status", "dw_cancel"],
    ["dw_policy_header", "dw_claim_header", "dw_claim_revision", "dw_claim_diagnosis", "dw_claim_details",
     "nps_scrubber_dnc", "nps_scrubber0", "bad_email"],
    ["dw_data_inforce", "policy_pets", "vouchers_issued", "nps_scrubber_policy", "dw_policy_pet", "dw_policy_term"],
]
# Tables that only rename, compute or join columns of stored or raw ones.  On demand they are
# read through, not stored again.
READ_THROUGH = {"policy_terms", "policy_term_base", "dw_policy_header", "dw_wp", "dw_policy_term", "policy_pets", "vouchers_issued",
                "dw_claim_header", "dw_claim_diagnosis", "dw_claim_details"}


def _code(prefix: str, n: Column) -> Column:
    """prefix || n padded to seven digits, longer numbers whole — insured codes and policy-number stems."""
    return F.concat(F.lit(prefix), _padded(n.cast("string")))


def _padded(digits: Column) -> Column:
    return F.lpad(digits, F.greatest(F.lit(7), F.length(digits)), F.lit("0"))


def _diagnosis_id() -> Column:
    return F.concat_ws("-", F.col("claim_id"), F.col("claim_revision_no").cast("string"))


def _hh_of_code(code: Column) -> Column:
    return F.substr(code, F.lit(2)).cast("long")


class FixtureWarehouse(Warehouse):
    """The domain tables of the pull, derived from ``sf_dir``'s parquet files."""

    def __init__(self, spark: SparkSession, sf_dir: str, hot_key_rows: int = 1_000_000):
        self.sf_dir = sf_dir.rstrip("/")
        self.hot_key_rows = hot_key_rows
        loaders = {name: getattr(self, f"_{name}") for name in DOMAIN_TABLES}
        for name in ("policy_terms", "policy_term_base", "policy_head"):
            loaders[name] = getattr(self, f"_{name}")
        loaders["claim_line"] = self._claim_line
        for raw in RAW_TABLES:
            loaders[raw] = (lambda raw=raw: spark.read.parquet(f"{self.sf_dir}/{raw}.parquet"))
        self._locks: dict[str, threading.RLock] = {}
        super().__init__(spark, loaders)

    def __getitem__(self, name: str) -> DataFrame:
        # one lock a table: stages that are built at the same time store it once
        with self._locks.setdefault(name, threading.RLock()):
            return super().__getitem__(name)

    def on_demand(self, root: str) -> Warehouse:
        """The tables of :meth:`land`, each made when it is first asked for.

        A query then pays for the tables that it reads, no others.  Those in
        :data:`READ_THROUGH` are read through to the tables they are made of;
        the others are stored once under ``root`` and read back.
        """
        def store(name: str, load) -> DataFrame:
            path = f"{root.rstrip('/')}/{name}"
            with shuffles_removed(self.spark):
                load().write.mode("overwrite").option("compression", "zstd").parquet(path, partitionBy=PARTITIONED_BY.get(name))
            return self.spark.read.parquet(path)

        for name, load in list(self._loaders.items()):
            if name not in RAW_TABLES and name not in READ_THROUGH:
                self._loaders[name] = lambda name=name, load=load: store(name, load)
        return Warehouse(self.spark, {name: (lambda name=name: self[name]) for name in DOMAIN_TABLES})

    def land(self, root: str) -> Warehouse:
        """Write every derived table once as parquet under ``root``; return
        a :class:`Warehouse` over the stored copies.

        The pull then reads plain stored tables, as it would in production,
        with predicate pushdown and column pruning into each scan, instead of
        re-deriving the mapping inside every query.  Tables are landed in
        dependency order and each later table reads the stored copy of the
        ones it is built from, so nothing is derived twice.
        """
        root = root.rstrip("/")

        def write(name: str) -> None:
            path = f"{root}/{name}"
            writer = self[name].write.mode("overwrite")
            if name in PARTITIONED_BY:
                writer = writer.partitionBy(PARTITIONED_BY[name])
            with shuffles_removed(self.spark):
                writer.parquet(path)
            self._frames[name] = self.spark.read.parquet(path)

        # Independent tables of a wave are written as concurrent Spark jobs.
        with ThreadPoolExecutor(max_workers=8) as pool:
            for wave in LAND_WAVES:
                list(pool.map(write, wave))
        return Warehouse.from_parquet(self.spark, root, DOMAIN_TABLES)

    # -- policies --------------------------------------------------------
    def _policy_terms(self) -> DataFrame:
        o = self["orders"]
        hh = F.col("o_custkey") * 4 + F.col("o_orderkey") % 4
        base = o.select("o_orderkey", hh.alias("hh"), "o_custkey",
                        F.col("o_orderdate").cast("date").alias("effective_date"), "o_orderdate", "o_orderpriority")
        # row_number per household; a household with very many orders is split
        numbered = row_number_per_key(base, ["hh"], ["o_orderdate", "o_orderkey"], "_rn",
                                      hot_rows=self.hot_key_rows)
        return numbered.withColumn("rn", (F.col("_rn") - 1).cast("int")).drop("_rn", "o_orderdate")

    def _order_lines(self) -> DataFrame:
        return self["lineitem"].groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.min("l_partkey").alias("first_part"), F.min("l_suppkey").alias("first_supp"),
            F.max("l_suppkey").alias("last_supp"))

    def _policy_term_base(self) -> DataFrame:
        return self["policy_terms"].join(self._order_lines(), "o_orderkey", "left")

    def _policy_head(self) -> DataFrame:
        """The header's columns that come of the order alone."""
        hh, rn, key = F.col("hh"), F.col("rn"), F.col("o_orderkey")
        renew = F.when(hh % 3 == 0, F.lit(0)).otherwise(hh % 19) + rn % 2
        return self["policy_terms"].select(
            key.alias("policyid"),
            F.concat(_code("P", hh), F.lit("-"), F.floor(rn / 2).cast("bigint").cast("string")).alias("policy_no"),
            renew.cast("int").alias("policy_renew_no"),
            _code("C", hh).alias("insured_code"),
            (F.col("o_custkey") % 25).cast("int").alias("zipcode_id"),
            "effective_date",
            F.substring("o_orderpriority", 1, 1).cast("int").alias("source_id"),
            (key % 25).alias("origin_id"),
            (key % 5).alias("paymentplan_id"),
        )

    def _dw_policy_header(self) -> DataFrame:
        key = F.col("policyid")
        # one row an order: the optimizer leaves the join out for readers that take none of its columns
        return self["policy_head"].join(self._order_lines().withColumnRenamed("o_orderkey", "policyid"), "policyid", "left").select(
            "policyid", "policy_no", "policy_renew_no", "insured_code", "zipcode_id", "effective_date",
            # no group, a group code unknown to the group table, or the first supplier
            F.when(key % 4 == 0, F.lit(None)).when(key % 13 >= 10, F.lit(-1)).otherwise(F.col("first_supp")).alias("group_id"),
            F.col("first_part").alias("breed_id"),
            "source_id", "origin_id", "paymentplan_id",
            F.when(key % 12 >= 8, F.lit(-1)).otherwise(F.col("last_supp")).alias("provider_id"),
        )

    def _dw_data_inforce(self) -> DataFrame:
        li = self["lineitem"].select("l_orderkey")
        o = self["orders"].select("o_orderkey", "o_orderstatus")
        period = F.when(F.col("o_orderstatus") == "F", F.lit(dt.date(2013, 1, 31))).otherwise(F.lit(dt.date(2013, 2, 28)))
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .select(F.col("l_orderkey").alias("policyid"), period.alias("reportperiod")))

    def _policy_pets(self) -> DataFrame:
        ph = self["dw_policy_header"].select("policy_no", "policy_renew_no", "breed_id")
        p = self["part"].select("p_partkey", "p_name", "p_size")
        dob = F.concat(F.lit("20"), F.lpad((F.col("p_size") % 13).cast("string"), 2, "0"), F.lit("-01-15")).cast("date")
        return (ph.join(p, p.p_partkey == ph.breed_id)
                .select(F.col("policy_no").alias("pp_policy_no"),
                        F.col("policy_renew_no").alias("pp_policy_renew_no"),
                        F.col("p_name").alias("pp_petname"),
                        F.when(F.col("p_size") % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("pp_pet_sex"),
                        dob.alias("pp_date_of_birth")))

    # -- policyholders -------------------------------------------------------
    def _insured_base(self) -> DataFrame:
        c = self["customer"]
        n = self["nation"].select("n_nationkey", "n_name")
        # four households per customer, without a cross join
        return (c.join(n, c.c_nationkey == n.n_nationkey)
                .withColumn("k", F.explode(F.array(*[F.lit(i) for i in range(4)])))
                .withColumn("hh", F.col("c_custkey") * 4 + F.col("k")))

    def _dw_dim_insured(self) -> DataFrame:
        b = self._insured_base()
        hh = F.col("hh")
        hs = hh.cast("string")
        # some households live in a zip code that the zip table does not know
        zip5 = (F.when(hh % 25 >= 22, F.lit(10000)).otherwise(F.lit(90000)) + F.col("c_nationkey")).cast("string")
        email = (F.when(hh % 10 == 0, F.lit(None).cast("string"))
                 .when(hh % 10 == 1, F.concat(F.lit("noemail"), hs))
                 .when(hh % 10 == 2, F.concat(F.lit("user."), hs))
                 .when(hh % 10 == 3, F.concat(F.when(hh % 20 == 3, F.lit("Shared")).otherwise(F.lit("SHARED")),
                                              F.floor(hh / 40).cast("bigint").cast("string"), F.lit("@Example.com")))
                 .otherwise(F.concat(F.lit("user"), hs, F.lit("@example.com"))))
        return b.select(
            _code("C", hh).alias("insured_code"),
            F.concat(F.lit("First"), (hh % 50).cast("string")).alias("insured_fname"),
            F.col("c_name").alias("insured_lname"),
            F.concat(hs, F.lit(" Main St")).alias("insured_address1"),
            F.lit(None).cast("string").alias("insured_address2"),
            F.concat(F.lit("City"), F.col("c_nationkey").cast("string")).alias("insured_city"),
            F.col("n_name").alias("insured_state"),
            F.concat(F.lit("555-"), _padded(hs)).alias("insured_hometel"),
            F.lit(None).cast("string").alias("insured_bustel"),
            (hh % 4 + 1).cast("int").alias("policy_inforce_cnt"),
            F.when(hh % 3 == 1, F.lit("Y")).otherwise(F.lit("N")).alias("portal_user_flag"),
            F.when(hh % 3 == 0, F.concat(F.lit("  "), zip5, F.lit("-1234"))).otherwise(zip5).alias("insured_zipcode"),
            email.alias("insured_email"),
        )

    # -- dimensions ------------------------------------------------------------
    def _dw_dim_breed(self) -> DataFrame:
        s = F.col("p_size")
        species = (F.when(s <= 20, F.lit("C")).when(s <= 38, F.lit("F")).when(s <= 41, F.lit("A"))
                   .when(s <= 44, F.lit("E")).when(s <= 46, F.lit("R")))
        return self["part"].select(F.col("p_partkey").alias("breed_id"), F.col("p_brand").alias("breed_code"),
                                   F.col("p_type").alias("breed_desc"), species.alias("speciescode"))

    def _dw_wp(self) -> DataFrame:
        k = F.col("o_orderkey")
        vrcc = F.when(k % 5 == 0, 99).when(k % 5 == 1, 144).when(k % 5 == 2, 264).otherwise(0)
        product = F.when(k % 8 == 0, "M10")
        for i, name in enumerate(["FS1", "I250", "I250G", "NI1", "WB1", "X1"], start=1):
            product = product.when(k % 8 == i, name)
        return self["orders"].select(k.alias("policyid"), vrcc.cast("int").alias("vrcc"),
                                     (k % 2).cast("int").alias("cancer"), product.otherwise("Z9").alias("baseproduct"))

    def _dw_dim_group(self) -> DataFrame:
        return self["supplier"].select(F.col("s_suppkey").alias("group_id"),
                                       F.concat(F.lit("G"), F.col("s_suppkey").cast("string")).alias("group_code"),
                                       F.col("s_name").alias("group_name"))

    def _dw_dim_provider(self) -> DataFrame:
        return self["supplier"].select(F.col("s_suppkey").alias("provider_id"), F.col("s_name").alias("provider_name"))

    def _dw_dim_origin(self) -> DataFrame:
        k = F.col("n_nationkey")
        code = (F.when(k == 0, F.lit("GD0082")).when(k == 1, F.lit("GP0083")).when(k == 2, F.lit(None))
                .otherwise(F.concat(F.lit("GD1"), F.lpad(k.cast("string"), 3, "0"))))
        return self["nation"].select(k.alias("origin_id"), F.col("n_name").alias("origin_type"), code.alias("origin_code"))

    def _dw_dim_paymentplan(self) -> DataFrame:
        return self["region"].select(F.col("r_regionkey").alias("paymentplan_id"), F.col("r_name").alias("paymentplandesc"),
                                     (F.col("r_regionkey") % 2).alias("paymentplantypeid"))

    def _dw_dim_payment_type(self) -> DataFrame:
        k = F.col("r_regionkey")
        return self["region"].select(
            k.alias("paymentplantype_id"), F.when(k == 0, F.lit("PIF")).otherwise(F.lit("MONTHLY")).alias("paymentplantype"))

    def _dw_dim_source(self) -> DataFrame:
        return self["orders"].select(F.substring("o_orderpriority", 1, 1).cast("int").alias("source_id"),
                                     F.col("o_orderpriority").alias("source_desc")).distinct()

    def _dw_dim_zipcode(self) -> DataFrame:
        k = F.col("n_nationkey")
        return self["nation"].select((F.lit(90000) + k).cast("string").alias("zipcode"),
                                     (F.lit(40000) + F.lit(1000) * k).cast("int").alias("incomeperhousehold"))

    # -- claims ------------------------------------------------------------------
    def _claim_line(self) -> DataFrame:
        li = row_number_per_key(
            self["lineitem"], ["l_orderkey", "l_linenumber"],
            ["l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus", "l_discount", "l_tax"],
            "_rev", hot_rows=self.hot_key_rows)
        ec = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        dc = F.round(F.col("l_discount") * 100).cast("bigint")

        def cents(expr: Column) -> Column:
            return (F.floor(expr).cast("decimal(14,2)") * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(12,2)")

        return li.select(
            "l_orderkey", "l_linenumber",
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("claim_id"),
            F.col("_rev").cast("int").alias("claim_revision_no"),
            "l_returnflag", "l_linestatus",
            cents(ec / 80).alias("claimedamount"),
            cents(ec * (100 - dc) / 8000).alias("eligibleamount"),
            cents(ec * (100 - dc) / 10000).alias("paidamount"),
        )

    def _dw_claim_header(self) -> DataFrame:
        # every claim's revisions are numbered from 1: its first line stands for it, no shuffle
        return (self["claim_line"].filter(F.col("claim_revision_no") == 1)
                .select(F.col("l_orderkey").alias("policyid"), "claim_id", F.concat(F.lit("CL"), "claim_id").alias("claim_no")))

    def _dw_claim_revision(self) -> DataFrame:
        reopened = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F")
        return self["claim_line"].select("claim_id", "claim_revision_no",
                                         F.when(reopened, F.lit("Reopened")).otherwise(F.lit("Complete")).alias("claim_revision_status"))

    def _dw_claim_diagnosis(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return self["claim_line"].select(
            "claim_id", "claim_revision_no",
            _diagnosis_id().alias("claim_diagnosis_id"),
            F.when(flag == "R", 1).when(flag == "A", 2).otherwise(3).alias("claim_coverage_id"))

    def _dw_claim_details(self) -> DataFrame:
        return self["claim_line"].select(_diagnosis_id().alias("claim_diagnosis_id"),
                                         "claimedamount", "eligibleamount", "paidamount")

    def _dw_dim_coverage(self) -> DataFrame:
        k = F.col("r_regionkey")
        return self["region"].select(
            (k + 1).cast("int").alias("coverage_id"),
            F.when(k == 0, F.lit("Wellcare")).when(k == 1, F.lit("Base")).otherwise(F.lit("Cancer")).alias("coverage_product_type"))

    # -- referrals and lists -----------------------------------------------------------
    def _vouchers_issued(self) -> DataFrame:
        e = self["events"].select("event_id", "user_id", "event_type")
        ph = self["dw_policy_header"].select("policyid", "policy_no", "policy_renew_no")
        return (e.join(ph, e.event_id == ph.policyid)
                .select(_code("C", F.col("user_id") * 4 + F.col("event_id") % 4).alias("vi_insured"),
                        F.col("policy_no").alias("vi_ref_policy_no"),
                        F.col("policy_renew_no").alias("vi_ref_policy_renew_no"),
                        F.when(F.col("event_type").isin("purchase", "signup"), F.lit("Y")).otherwise(F.lit("N")).alias("vi_redeemed_yn")))

    def _nps_scrubber_policy(self) -> DataFrame:
        ph = self["dw_policy_header"]
        return ph.filter(F.col("policyid") % 97 == 0).select(
            F.concat(F.lit(" "), F.col("policy_no"), F.lit(" ")).alias("policy_no"), F.lit("G1").alias("source"))

    def _nps_scrubber_dnc(self) -> DataFrame:
        i = self["dw_dim_insured"]
        listed = i.filter(_hh_of_code(F.col("insured_code")) % 17 == 0).select(
            F.upper("insured_email").alias("email"), F.lit("H").alias("source"))
        extra = self.spark.range(1).select(F.lit("nobody@nowhere.test").alias("email"), F.lit("H").alias("source"))
        return listed.unionByName(extra)

    def _nps_scrubber0(self) -> DataFrame:
        i = self["dw_dim_insured"]
        hh = _hh_of_code(F.col("insured_code"))
        lists = F.array(*[F.lit(name) for name in LIST_SOURCES])
        return i.filter(hh % 29 == 0).select(
            F.concat(F.col("insured_code"), F.lit(" ")).alias("insured_code"),
            F.get(lists, F.floor(hh / 29).cast("int") % len(LIST_SOURCES)).alias("source"))

    def _bad_email(self) -> DataFrame:
        i = self["dw_dim_insured"]
        return i.filter(_hh_of_code(F.col("insured_code")) % 23 == 0).select(F.upper("insured_email").alias("bad_email"))

    # -- status and cancellations ---------------------------------------------------------
    def _dw_policy_pet(self) -> DataFrame:
        ph = self["dw_policy_header"]
        return ph.groupBy("policy_no").agg((F.min("policyid") % 10).cast("int").alias("policy_status_dwid"))

    def _dw_dim_policy_status(self) -> DataFrame:
        k = F.col("n_nationkey")
        desc = F.when(k < 7, F.lit("Inforce")).when(k < 9, F.lit("Inforce (Undernotice)")).otherwise(F.lit("Cancelled"))
        return self["nation"].select(k.cast("int").alias("policy_status_dwid"), desc.alias("policy_status_desc"))

    def _dw_policy_term(self) -> DataFrame:
        return self["dw_policy_header"].select(F.col("policyid").alias("policy_term_dwid"), "policy_no", "policy_renew_no")

    def _dw_cancel(self) -> DataFrame:
        k = F.col("o_orderkey")
        eff = F.when(k % 2 == 0, F.lit(dt.date(2013, 6, 30))).otherwise(F.lit(dt.date(2012, 6, 30)))
        return self["orders"].filter((k % 15).isin(0, 1)).select(k.alias("policy_term_dwid"), eff.alias("effective_date"))

"""The pipeline's steps over one folder of append-only tables.

Every step writes its rows under a new epoch and then commits that epoch. Readers see
committed epochs only, so a step that dies half-way leaves no trace and is simply run again.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quillon.config import DatasetSpec, Limits
from quillon.functions.keys import content_hash
from quillon.operators import batches as bt
from quillon.operators import cleanup as cl
from quillon.operators import fetch as fe
from quillon.operators import images as im
from quillon.operators import orphans as orp
from quillon.operators import points as pt
from quillon.operators import results as rs
from quillon.operators import shards as sh
from quillon.operators import state as st
from quillon.operators import verify as vf
from quillon.operators.contract import is_image_struct
from quillon.operators.dedupe import insert_or_ignore
from quillon.operators.embed import Embedder, answer_requests, embed_texts
from quillon.operators.jobs import latest_states
from quillon.operators.normalize import normalize, split_null_ids
from quillon.operators.rollup import ProfileStore
from quillon.operators.sampling import pilot, seeded_sample
from quillon.session import materialize
from quillon.sources.bucketed import BucketedLog
from quillon.sources.epochs import read_epochs, read_or_empty, write_epoch
from quillon.sources.packs import one_place, pack_index
from quillon.sources.results import POSITION, attach_batches, read_result_lines, unknown_lines, write_result_files

SCHEMAS = {
    "records": "record_id string, point_id string, text string, image_url string, payload string",
    "record_events": st.EVENT_SCHEMA,
    "state": (
        "record_id string, image_status string, image_sha string, embed_status string, "
        "embed_attempts int, batch_id string, shard_id bigint, upsert_status string, updated_seq bigint"
    ),
    "batch_events": bt.BATCH_EVENT_SCHEMA,
    "vectors": (
        "batch_id string, record_id string, point_id string, vector array<float>, known boolean, "
        "file_path string, file_block bigint, line_no bigint"
    ),
    "collected": "batch_id string",
    "layout": "buckets int",
}


#: Steps that write events of batches, each time; "settled" is a poll that freed no records.
BATCH_STEPS = ("build_shards", "submitted", "polled", "settled", "cancel")
#: Steps that free records of failed batches.
RESET_STEPS = ("polled", "cancel")
#: What a session has written for itself, folded batches and the index of requests, is read
#: again for so long, unless a step has changed it.
KEPT_SECONDS = 3600


def _within(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows between the least and the greatest wanted id: a filter that scans use to skip what they can."""
    low, high = wanted.agg(F.min(column), F.max(column)).first()
    return rows.where(F.lit(False) if low is None else F.col(column).between(low, high))


class Workspace:
    """One dataset's pipeline: ingest, fetch, shard, submit, collect, upsert, audit."""

    def __init__(
        self, spark: SparkSession, root: str, spec: DatasetSpec,
        limits: Limits = Limits(), model: str = "models/embedder", buckets: int | None = None,
    ):
        """``buckets`` of vectors and points, fixed when the folder is first used.

        By default as many as the session has shuffle partitions.
        """
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec
        self.limits, self.model = limits, model
        self._committed: dict[int, str] = {}
        self._commit_files: set[str] = set()
        self._looked = False
        self._folded: tuple[set[int], DataFrame, float] | None = None
        self._indexed: tuple[list[int], DataFrame, float] | None = None
        n = self._layout(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
        self._vectors = BucketedLog(spark, self._path("vectors"), SCHEMAS["vectors"], "record_id", n)
        self._points = pt.PointStore(spark, self._path("points"), n)
        self._profiles = ProfileStore(spark, self._path("profiles"))

    def _layout(self, buckets: int) -> int:
        schema = T.StructType.fromDDL(SCHEMAS["layout"])
        stored = read_or_empty(self.spark, self._path("layout"), schema).agg(F.min("buckets")).first()[0]
        if stored is None:
            self.spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.mode("append").parquet(self._path("layout"))
        return stored or buckets

    # Tables.

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def commits(self) -> dict[int, str]:
        """Epochs of finished steps with the step's name: one entry per step ever run."""
        if not self._looked:
            schema, folder = T.StructType.fromDDL("epoch bigint, step string"), self._path("commits")
            stored = read_or_empty(self.spark, folder, schema)
            # A commit is a file that never changes: those known are listed, but not read again.
            names = {f.rsplit("/", 1)[-1] for f in stored.inputFiles()}
            if new := sorted(names - self._commit_files):
                if self._commit_files:
                    stored = self.spark.read.schema(schema).parquet(*[f"{folder}/{name}" for name in new])
                found = {r.epoch: r.step for r in stored.collect()}
                self._committed = dict(sorted({**self._committed, **found}.items()))
                self._commit_files = names
            self._looked = True
        return self._committed

    def refresh(self) -> None:
        """Look for steps committed by other sessions; every step does so when it starts."""
        self._looked = False

    def _read(self, table: str, after: int = -1) -> DataFrame:
        stored = read_epochs(self.spark, self._path(table), SCHEMAS[table])
        return stored.where(F.col("epoch").isin([e for e in self.commits() if e > after]))

    def _written_by(self, table: str, *steps: str, after: int = -1) -> DataFrame:
        """Rows of a table by steps that write it each time: only their folders are looked at."""
        epochs = [e for e, step in self.commits().items() if step in steps and e > after]
        return read_epochs(self.spark, self._path(table), SCHEMAS[table], epochs)

    def records(self) -> DataFrame:
        return self._written_by("records", "ingest").drop("epoch")

    def blobs(self) -> DataFrame:
        return im.stored_blobs(self.spark, self._path("blobs"))

    def request_index(self) -> DataFrame:
        """Where each shard's requests lie (epoch, shard_id, pack, offset, length)."""
        packed = sh.request_index(self.spark, self._path("requests"))
        return packed.where(F.col("epoch").isin(self._epochs_of("build_shards")))

    def requests(self, shards: DataFrame | None = None) -> DataFrame:
        """(shard_id, value): request lines of all shards, or of those in ``shards`` (shard_id)."""
        places = self.request_index()
        if shards is not None:
            places = places.join(shards.select("shard_id"), "shard_id", "left_semi")
        return sh.read_request_shards(places, self._path("requests")).select("shard_id", "value")

    def state(self, only: DataFrame | None = None) -> DataFrame:
        """Current state of every record, or of those in ``only`` (record_id): the last snapshot plus newer events."""
        return self._state(only)

    def _state(self, only: DataFrame | None, *steps: str) -> DataFrame:
        """With ``steps`` the newer events of these alone: right for columns that no other step sets."""
        def events(after: int = -1) -> DataFrame:
            logged = self._written_by("record_events", *steps, after=after) if steps else self._read("record_events", after)
            return logged.drop("epoch")

        if only is not None:
            low, high = only.agg(F.min("record_id"), F.max("record_id")).first()
            between = F.lit(False) if low is None else F.col("record_id").between(low, high)

        def picked(rows: DataFrame) -> DataFrame:
            return rows if only is None else rows.where(between).join(only.select("record_id"), "record_id", "left_semi")

        records = picked(self.records().select("record_id"))
        snapshots = [e for e, step in self.commits().items() if step == "compact"]
        if not snapshots:
            folded = st.fold_events(picked(events()))
        else:
            newest = max(snapshots)
            snapshot = picked(self._read("state", after=newest - 1).drop("epoch"))
            inserted = records.select(
                "record_id", F.lit(0).cast("long").alias("seq"), F.lit("insert").alias("event")
            )
            newer = picked(events(newest))
            unseen = inserted.join(snapshot.select("record_id").hint("merge"), "record_id", "left_anti")
            folded = st.apply_events(snapshot, newer.unionByName(st.as_events(unseen)))
        # A record exists as soon as it is ingested; without events it is all pending.
        return records.join(folded.hint("merge"), "record_id", "left").select(
            "record_id",
            F.coalesce("image_status", F.lit("pending")).alias("image_status"),
            "image_sha",
            F.coalesce("embed_status", F.lit("pending")).alias("embed_status"),
            F.coalesce("embed_attempts", F.lit(0)).alias("embed_attempts"),
            "batch_id", "shard_id",
            F.coalesce("upsert_status", F.lit("pending")).alias("upsert_status"),
            F.coalesce("updated_seq", F.lit(0).cast("long")).alias("updated_seq"),
        )

    def _members(self, step: str, event: str, column: str, wanted: DataFrame) -> DataFrame:
        """(record_id): records that an event of a step ever gave one of the wanted ids, written once, perhaps repeated.

        State of these alone is folded where a step changes a few shards or batches.
        """
        named = _within(self._written_by("record_events", step).where(F.col("event") == event), column, wanted)
        return materialize(named.join(wanted.select(column), column, "left_semi").select("record_id"), "members")

    def _undone(self, failed: DataFrame, seq: int) -> DataFrame:
        """Events that free the records of failed batches (batch_id)."""
        members = self._members("submitted", "submit", "batch_id", failed)
        return st.reset_events(self._state(members, "submitted", *RESET_STEPS), failed, seq)

    def batches(self) -> DataFrame:
        """Current row of every batch.

        Written once after each step that changes them: what this session folded before
        meets the events of newer steps alone. Steps of other sessions that were begun
        before, and ended after, what it folded make it fold the whole log again.
        """
        done = {e for e, step in self.commits().items() if step in BATCH_STEPS}
        known, rows, until = self._folded or (set(), None, 0.0)
        late = any(e < max(known, default=-1) for e in done - known)
        if late or time.monotonic() > until:
            known, rows = set(), None
        if rows is None or done != known:
            events = read_epochs(self.spark, self._path("batch_events"), SCHEMAS["batch_events"], done - known).drop("epoch")
            if rows is not None:
                events = events.unionByName(bt.as_batch_events(rows, -1))
            rows = materialize(bt.fold_batches(events), "batches")
            self._folded = done, rows, time.monotonic() + KEPT_SECONDS
        return rows

    def _epochs_of(self, step: str) -> list[int]:
        return [e for e, done in self.commits().items() if done == step]

    def vectors(self) -> DataFrame:
        """All vectors ever collected, bucketed by record."""
        return self._vectors.read(self._epochs_of("collect"))

    def points(self) -> DataFrame:
        """The current point of every record."""
        return self._points.current(self._epochs_of("upsert"))

    def _next_epoch(self) -> int:
        self.refresh()
        return max([int(time.time() * 1000), *(e + 1 for e in self.commits())])

    def _commit(self, step: str, epoch: int, **tables: DataFrame) -> None:
        for table, rows in tables.items():
            write_epoch(rows, self._path(table), epoch)
        done = self.spark.range(1).select(F.lit(epoch).cast("long").alias("epoch"), F.lit(step).alias("step"))
        done.coalesce(1).write.mode("append").parquet(self._path("commits"))
        self.commits()[epoch] = step

    # Steps.

    def ingest(
        self, df: DataFrame, order: list[str], row_index: str | None = None, limit: int | None = None, profiled: bool = False,
    ) -> DataFrame:
        """Add rows whose id is new; among copies of an id the first by ``order`` wins.

        ``order`` names columns of ``df``. ``limit`` takes only the first rows by the first
        of them, for a trial. With ``profiled`` the rows read, whether new or not, count in
        ``profile()``, for one more pass over them. Returns one row of counts.
        """
        if limit is not None:
            df = materialize(pilot(df, order[0], limit), "pilot")
        epoch = self._next_epoch()
        column = self.spec.image_column
        pictures = column in df.columns and not isinstance(df.schema[column].dataType, T.StringType)
        if pictures and is_image_struct(df.schema[column].dataType):
            # Read several times below; every picture is shrunk once.
            df = materialize(im.shrink_column(df, column, self.limits.image_max_side), "shrunk")
        normalized = normalize(df, self.spec, row_index, keep=order)
        usable, _ = split_null_ids(normalized)
        if pictures:
            im.store_blobs(usable.select(im.stored_content("image").alias("content")), self._path("blobs"))
            # Only hashes travel through the shuffles below.
            usable = usable.withColumn("sha", content_hash(im.stored_content("image")))
            usable = usable.withColumn("had_image", F.col("image").isNotNull())
        fresh = insert_or_ignore(
            self.records(), usable.drop("image"), ["record_id"], [f"_order_{c}" for c in order]
        )
        fresh = materialize(fresh, "fresh")
        if profiled:
            self._profiles.add(df, epoch)
        tables = {"records": fresh.select(*T.StructType.fromDDL(SCHEMAS["records"]).names)}
        if pictures:
            tables["record_events"] = im.embedded_image_events(fresh.where("had_image"), 2 * epoch)
        self._commit("ingest", epoch, **tables)
        inserted = fresh.agg(F.count(F.lit(1)).alias("n"))
        return normalized.agg(
            F.count(F.lit(1)).alias("rows_read"),
            F.count_if(F.col("record_id").isNull()).alias("quarantined"),
        ).withColumn("inserted", inserted.scalar())

    def fetch(
        self, make_fetcher: Callable[[], fe.Fetcher], sleep: Callable[[float], None] = time.sleep
    ) -> DataFrame:
        """Fetch the pictures of records whose image is pending; returns counts by outcome."""
        epoch = self._next_epoch()
        pending = st.pending_images(self.state()).select("record_id").join(
            self.records().select("record_id", "image_url"), "record_id"
        )
        fetched = fe.fetch_urls(pending, make_fetcher, self.limits, sleep=sleep)
        im.store_blobs(fetched.where(fe.fetched_ok()), self._path("blobs"))
        outcomes = fe.fetch_outcomes(pending, fetched)
        events = st.as_events(outcomes.withColumns({"event": F.lit("image"), "seq": F.lit(2 * epoch)}))
        self._commit("fetch", epoch, record_events=events)
        done = self._read("record_events").where(F.col("epoch") == epoch)
        return fe.outcome_counts(done)

    def build_shards(self) -> DataFrame:
        """Chunk eligible records into shards and write their request files; returns the shards."""
        epoch = self._next_epoch()
        eligible = st.embeddable(self.state(), self.spec.modality, self.limits.max_attempts)
        content = eligible.select("record_id", "image_sha").join(
            self.records().select("record_id", "text").hint("merge"), "record_id"
        )
        usable, _ = sh.split_by_content(content, self.spec, F.col("image_sha").isNotNull())
        assignment = materialize(sh.assign_shards(usable, self.batches(), self.limits), "assignment")
        lines = sh.request_lines(
            usable, assignment, self.spec, dim=self.limits.embedding_dim, model=self.model,
            blobs=self._path("blobs") if self.spec.needs_image else None,
        )
        sh.write_request_shards(lines, self._path("requests"), epoch)
        shards = sh.shard_batches(assignment, self.limits)
        self._commit(
            "build_shards", epoch,
            batch_events=bt.as_batch_events(shards, 2 * epoch),
            record_events=sh.assign_events(assignment, 2 * epoch),
        )
        return self.batches().join(assignment.select("shard_id").distinct(), "shard_id", "left_semi")

    def admit(self) -> DataFrame:
        """Shards that may be submitted now."""
        return sh.admission_round(self.batches(), self.limits)

    def submitted(self, jobs: DataFrame) -> None:
        """Record submitted jobs (shard_id, batch_id)."""
        epoch = self._next_epoch()
        sent = jobs.select("shard_id", "batch_id").withColumn("state", F.lit("SUBMITTED"))
        members = self._members("build_shards", "assign", "shard_id", jobs)
        self._commit(
            "submitted", epoch,
            batch_events=bt.as_batch_events(sent, 2 * epoch),
            record_events=st.submit_events(self._state(members, "build_shards", *RESET_STEPS), jobs, 2 * epoch),
        )

    def embed(self, make_embedder: Callable[[], Embedder], results: str) -> DataFrame:
        """Answer all submitted shards in Spark, in place of a remote job; returns their polls.

        Reads the packed requests and writes one result folder per batch.
        """
        active = st.active_batches(self.batches()).select("batch_id", "shard_id")
        built = self._epochs_of("build_shards")
        known, index, until = self._indexed or ([], None, 0.0)
        if index is None or built != known or time.monotonic() > until:
            index = materialize(self.request_index(), "requests")
            self._indexed = built, index, time.monotonic() + KEPT_SECONDS
        asked = sh.read_request_shards(index.join(active, "shard_id"), self._path("requests")).select("batch_id", "value")
        answers = answer_requests(asked, make_embedder, self.limits.embedding_dim)
        write_result_files(answers, results)
        return active.select(
            "batch_id", F.lit(0).cast("long").alias("seq"), F.lit("JOB_STATE_SUCCEEDED").alias("job_state")
        )

    def polled(self, polls: DataFrame) -> DataFrame:
        """Apply job polls (batch_id, seq, job_state); failed jobs free their records."""
        epoch = self._next_epoch()
        known = st.active_batches(self.batches()).select(
            "batch_id", "shard_id", F.col("state").alias("_old")
        )
        changed = latest_states(polls).join(known, "batch_id").where("state <> _old")
        changed = materialize(changed.select("batch_id", "shard_id", "state"), "polled")
        failed = st.failed_batches(changed)
        freed = {} if failed.isEmpty() else {"record_events": self._undone(failed, 2 * epoch)}
        step = "polled" if freed else "settled"
        self._commit(step, epoch, batch_events=bt.as_batch_events(changed, 2 * epoch), **freed)
        return changed

    def cancel(self, batch_ids: DataFrame) -> None:
        """Give up batches: they become FAILED and all their records are pending again."""
        epoch = self._next_epoch()
        hit = self.batches().join(batch_ids.select("batch_id"), "batch_id", "left_semi")
        failed = hit.select("shard_id", "batch_id").withColumn("state", F.lit("FAILED"))
        self._commit(
            "cancel", epoch,
            batch_events=bt.as_batch_events(failed, 2 * epoch),
            record_events=self._undone(failed, 2 * epoch),
        )

    def collect(self, results: str) -> DataFrame:
        """Take in the result files of succeeded batches, once each; returns one row of totals."""
        epoch = self._next_epoch()
        done = self.vectors().select("batch_id", "record_id")
        batches = st.succeeded_batches(self.batches()).select("batch_id").join(
            self._read("collected").select("batch_id"), "batch_id", "left_anti"
        )
        read = read_result_lines(self.spark, results)
        unknown = unknown_lines(read, self.batches().where("batch_id IS NOT NULL"))
        lines = attach_batches(read, batches)
        parsed = materialize(rs.parse_result_lines(lines, self.limits.embedding_dim), "parsed")
        vectors = rs.collect_vectors(parsed, self.records(), done)
        self._vectors.write(self._vectors.placed(vectors), epoch)
        self._commit(
            "collect", epoch,
            record_events=rs.result_events(parsed, epoch),
            collected=parsed.select("batch_id").distinct(),
        )
        lost = unknown.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        return rs.collect_totals(parsed).withColumn("unknown", lost.scalar())

    def upsert(self) -> DataFrame:
        """Store the points of embedded records; returns one row of counts."""
        epoch = self._next_epoch()
        state = materialize(self.state().select("record_id", "embed_status", "upsert_status"), "state")
        vectors = self.vectors()
        incoming = pt.points_to_upsert(state, self.records(), vectors, ["epoch", *POSITION])
        written = self._points.write(incoming, epoch, self._epochs_of("upsert"))
        skipped = pt.upsert_skipped(state, vectors).agg(F.count(F.lit(1)).alias("n"))
        counts = written.agg(F.count(F.lit(1)).alias("upserted")).withColumn("skipped", skipped.scalar())
        counts = materialize(counts, "counts")
        self._commit("upsert", epoch, record_events=pt.upsert_events(written, 2 * epoch))
        return counts

    def compact(self) -> None:
        """Fold the log into a snapshot; later reads start from it."""
        epoch = self._next_epoch()
        self._commit("compact", epoch, state=self.state())

    # Reports.

    def status(self) -> tuple[DataFrame, DataFrame]:
        """(metric rows, batches by state)."""
        return vf.metric_rows(st.status_counts(self.state())), st.batch_states(self.batches())

    def verify(self, make_embedder: Callable[[], Embedder] | None = None, seed: int = 42) -> DataFrame:
        """All audits as (check, status, ok, n) rows; recall needs an embedder and a template."""
        state = materialize(self.state().select("record_id", "upsert_status"), "state")
        records, points = self.records(), self.points()
        dim = self.limits.embedding_dim
        report = vf.count_match(state, points).unionByName(vf.spot_check(state, records, points, seed=seed))
        report = report.unionByName(vf.self_search_check(points, dim, seed=seed)).unionByName(vf.size_check(points, dim))
        if make_embedder is None or not self.spec.template_columns:
            return report.unionByName(vf.skipped_check("cross_modal", self.spark))
        stored = state.where("upsert_status = 'ok'").select("record_id")
        sample = seeded_sample(stored, "record_id", vf.RECALL_SAMPLE, seed).join(
            records.select("record_id", "text"), "record_id"
        )
        asked = embed_texts(sample.where(F.trim("text") != ""), make_embedder, dim)
        return report.unionByName(vf.recall_check(vf.recall_hits(sample, points, asked, dim)))

    def profile(self) -> DataFrame:
        """Profile of all rows ever ingested with ``profiled``, from the sketches of their epochs."""
        return self._profiles.profile(self._epochs_of("ingest"))

    def orphans(self, before: int) -> DataFrame:
        """(kind, name, bytes): stored files and blobs that no committed step refers to.

        Leaves out what may belong to a step begun at ``before`` (milliseconds) or later.
        """
        files = orp.stored_files(self.spark, self.root)
        epochs = self.spark.createDataFrame([(e,) for e in self.commits()], "epoch bigint")
        found = orp.orphan_epochs(files, epochs, before)
        blobs = pack_index(self.spark, self._path("blobs"))
        places, used = one_place(blobs), self.state().select(F.col("image_sha").alias("key"))
        read = places.join(used.distinct(), "key", "left_semi").select("pack")
        found = found.unionByName(orp.orphan_packs(files, self.request_index().select("pack").unionByName(read), before))
        return found.unionByName(orp.orphan_entries(blobs, places, used))

    def reclaimable(
        self, shard_files: DataFrame, result_files: DataFrame, image_files: DataFrame, scope: str = "all"
    ) -> DataFrame:
        """What could be deleted, by kind of artifact, from listings of the files there are.

        Shards are listed by ``request_files(self.request_index())``; a pack can go once all its shards can.
        """
        return cl.reclaimable(
            self.batches(), self.state(), cl.artifact_files(shard_files), cl.artifact_files(result_files),
            image_files, scope,
        )

"""Session building: object store, state store and shuffle settings."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class StoreConfig:
    """Where the lake lives.

    ``endpoint`` is the single switch: set, the store is addressed path-style
    with static keys; empty, the connector's default credential chain applies.
    """

    endpoint: str = ""
    access_key: str = ""
    secret_key: str = ""
    region: str = ""

    @staticmethod
    def from_env() -> StoreConfig:
        return StoreConfig(
            endpoint=os.getenv("S3_ENDPOINT", ""),
            access_key=os.getenv("AWS_ACCESS_KEY_ID", ""),
            secret_key=os.getenv("AWS_SECRET_ACCESS_KEY", ""),
            region=os.getenv("AWS_REGION", ""),
        )

    def spark_confs(self) -> dict[str, str]:
        s3a = "spark.hadoop.fs.s3a."
        # Setting names and classes of the store connector.
        confs = {
            s3a + "impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
            s3a + "fast.upload": "true",
        }
        if self.region:
            confs[s3a + "endpoint.region"] = self.region
        if self.endpoint:
            tls = self.endpoint.startswith("https://")
            confs |= {
                s3a + "endpoint": self.endpoint,
                s3a + "path.style.access": "true",
                s3a + "connection.ssl.enabled": str(tls).lower(),
                s3a + "aws.credentials.provider": "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
                s3a + "access.key": self.access_key,
                s3a + "secret.key": self.secret_key,
            }
        return confs


STREAM_STATE_CONFS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

BASE_CONFS = {
    # dt and hour are derived from UTC wall time
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(
    app_name: str,
    *,
    store: StoreConfig | None = None,
    streaming: bool = False,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    confs: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the lake's settings; ``confs`` wins over all of them.

    For a stateful stream ``shuffle_partitions`` is fixed by its checkpoint,
    so size it for the cluster before the first start. Batch jobs may leave it
    unset and let adaptive execution coalesce.
    """
    settings = dict(BASE_CONFS)
    if store is not None:
        settings |= store.spark_confs()
    if streaming:
        settings |= STREAM_STATE_CONFS
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings |= confs or {}

    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``; without
    that setting the warehouse is the storage that driver and executors share.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

"""Job parameters. Names on the command line follow the pipeline's option names."""

from __future__ import annotations

from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class KeyConfig:
    """Where the key-encrypting key lives; together the parts form its resource name."""

    projectId: str = "local-project"
    locationId: str = "global"
    keyRing: str = "forms"
    keyId: str = "forms-key"

    @property
    def name(self) -> str:
        return (f"projects/{self.projectId}/locations/{self.locationId}"
                f"/keyRings/{self.keyRing}/cryptoKeys/{self.keyId}")


@dataclass(frozen=True)
class RetryConfig:
    """Seconds to wait after each failed append; one attempt per entry."""

    waits: tuple[float, ...] = (20.0, 40.0, 60.0, 0.0)


@dataclass(frozen=True)
class PublishConfig:
    topic: str
    prefixes: str = ""
    keys: KeyConfig = KeyConfig()
    # Retry settings of the topic client, in milliseconds.
    initialRetryDelay: int = 100
    maxRetryDelay: int = 60_000
    rpcTimeout: int = 1_000
    totalTimeout: int = 600_000

    def kafka_options(self) -> dict[str, str]:
        return {
            "kafka.retry.backoff.ms": str(self.initialRetryDelay),
            "kafka.retry.backoff.max.ms": str(self.maxRetryDelay),
            "kafka.request.timeout.ms": str(self.rpcTimeout),
            "kafka.delivery.timeout.ms": str(self.totalTimeout),
        }


@dataclass(frozen=True)
class IngestConfig:
    inputSubscription: str
    root: str
    bucketName: str = "forms"
    baseUrl: str = "https://storage.example.com/"
    dataSet: str | None = None
    rulesPath: str | None = None
    deadLetterTopicId: str | None = None
    keys: KeyConfig = KeyConfig()
    retry: RetryConfig = RetryConfig()
    onDeidError: str = "reject"
    collision: str = "reject"
    cryptohashing: str = "seal"
    parallelForms: int = 8
    inputPartitions: int | None = None
    triggerSeconds: int = 10
    maxFilesPerTrigger: int | None = None
    redeliverySeconds: int | None = None
    extra: dict = field(default_factory=dict)

    @property
    def staging(self) -> str:
        return f"{self.root}/staging"

    @property
    def archive(self) -> str:
        return f"{self.root}/archive/{self.bucketName}"

    @property
    def errors(self) -> str:
        return f"{self.root}/errorDataTable"

    @property
    def dead_letter(self) -> str:
        return self.deadLetterTopicId or f"{self.root}/dead_letter"

    @property
    def rules(self) -> str:
        return self.rulesPath or f"{self.root}/form_dlp_config"

    @property
    def runs(self) -> str:
        return f"{self.root}/runs"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint"


def kafka_options(given: dict[str, str]) -> dict[str, str]:
    """The ``--kafka.*`` options, such as ``kafka.bootstrap.servers``."""
    return {name: value for name, value in given.items() if name.startswith("kafka.")}


def parse_args(argv: list[str]) -> dict[str, str]:
    """``--name=value`` arguments as a dict."""
    pairs = (a[2:].partition("=") for a in argv if a.startswith("--"))
    return {name: value for name, _, value in pairs}


def ingest_config(argv: list[str]) -> IngestConfig:
    given = parse_args(argv)
    missing = [n for n in ("inputSubscription", "root") if not given.get(n)]
    if missing:
        raise ValueError(f"missing required option: {', '.join(missing)}")
    key_names = {f.name for f in fields(KeyConfig)}
    plain = {f.name: f for f in fields(IngestConfig)}
    numbers = {"parallelForms", "inputPartitions", "triggerSeconds", "maxFilesPerTrigger", "redeliverySeconds"}
    kwargs = {n: int(v) if n in numbers else v
              for n, v in given.items() if n in plain and n not in ("keys", "retry", "extra")}
    extra = {n: v for n, v in given.items() if n not in plain and n not in key_names and n != "waits"}
    retry = RetryConfig(tuple(float(w) for w in given["waits"].split(","))) if "waits" in given else RetryConfig()
    keys = KeyConfig(**{n: v for n, v in given.items() if n in key_names})
    return IngestConfig(**kwargs, keys=keys, retry=retry, extra=extra)

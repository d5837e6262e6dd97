"""Parameters of the operators, as plain frozen values."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from sheafline import fixed_values as fv


@dataclass(frozen=True)
class ChunkSpec:
    """How one text is cut. ``mode`` is ``none``, ``fixed`` or ``overlap``."""

    mode: str = "overlap"
    size: int = fv.CHUNK_SIZE
    overlap: int = fv.CHUNK_OVERLAP

    def __post_init__(self):
        if self.mode not in ("none", "fixed", "overlap"):
            raise ValueError(f"unknown chunk mode {self.mode!r}")
        if self.mode == "none":
            return
        if self.size < 1:
            raise ValueError("chunk size must be positive")
        if not 0 <= self.shared < self.size:
            raise ValueError("chunk overlap must be at least 0 and below the chunk size")

    @property
    def shared(self) -> int:
        return self.overlap if self.mode == "overlap" else 0

    @property
    def step(self) -> int:
        return self.size - self.shared


@dataclass(frozen=True)
class ChunkRule:
    """Files whose path matches ``glob`` are cut by ``spec``."""

    glob: str
    spec: ChunkSpec


def default_chunk_rules() -> tuple[ChunkRule, ...]:
    return tuple(
        ChunkRule(
            g["glob"],
            ChunkSpec(g["mode"], g.get("size", fv.CHUNK_SIZE), g.get("overlap", 0)),
        )
        for g in fv.CHUNK_GLOBS
    )


@dataclass(frozen=True)
class AgentRule:
    """Documents at ``prefix`` or anywhere below it belong to ``agent``."""

    agent: str
    prefix: str


def default_agent_rules() -> tuple[AgentRule, ...]:
    return tuple(AgentRule(a, p) for a, paths in fv.AGENT_PATHS.items() for p in paths)


@dataclass(frozen=True)
class Settings:
    """One bundle handed to a whole run. With ``chunk_rules`` every document is cut
    as its path asks for, and whole if no rule fits; else all are cut by ``chunking``."""

    landing_root: str
    path_base: str | None = None
    chunking: ChunkSpec = field(default_factory=ChunkSpec)
    chunk_rules: tuple[ChunkRule, ...] | None = None
    agents: tuple[AgentRule, ...] = field(default_factory=default_agent_rules)
    default_agent: str = fv.DEFAULT_AGENT
    embed_batch: int = fv.EMBED_BATCH
    embed_tasks: int | None = None
    id_scope: str = "name"

    def __post_init__(self):
        object.__setattr__(self, "landing_root", as_root(self.landing_root))
        if self.id_scope not in ("name", "path"):
            raise ValueError("id_scope must be 'name' or 'path'")

    @classmethod
    def from_session(cls, spark: SparkSession, default_root: str, **kw) -> "Settings":
        """Take the landing root from the session setting ``s3_landing_path``."""
        return cls(spark.conf.get("s3_landing_path", default_root), **kw)


def as_root(path: str) -> str:
    """A folder path with exactly one slash at its end."""
    return path.rstrip("/") + "/"

"""Named sources and the places they resolve to: configuration, on the driver."""

from __future__ import annotations

from dataclasses import dataclass, field

COMMON_KEYS = ("document_type", "department_name", "alb", "date")


@dataclass(frozen=True)
class Location:
    """Where a source lies: our own store by environment, or another's with a copy or direct access for development."""

    name: str
    ours: bool = True
    production: str | None = None
    development_copy: str | None = None
    cross_account: bool = False

    def __post_init__(self) -> None:
        if not self.ours and (self.production is None or (self.development_copy is None) == (not self.cross_account)):
            raise ValueError("a store of others needs its production place and exactly one way for development")

    def resolve(self, environment: str) -> str:
        if self.ours:
            return f"{self.name}-{environment}"
        if environment == "prod" or self.cross_account:
            return self.production
        return self.development_copy


@dataclass(frozen=True)
class Source:
    name: str
    document_type: str
    location: Location
    prefix: str = ""
    extensions: tuple[str, ...] = (".pdf", ".docx")
    extra_keys: tuple[str, ...] = ()
    pipelines: tuple[str, ...] = field(default=("text",))

    def __post_init__(self) -> None:
        if not self.pipelines:
            raise ValueError(f"{self.name} feeds no pipeline")

    @property
    def metadata_keys(self) -> tuple[str, ...]:
        return COMMON_KEYS + self.extra_keys


class Registry:
    def __init__(self, sources: list[Source]) -> None:
        self._sources = {s.name: s for s in sources}
        if len(self._sources) != len(sources):
            raise ValueError("a name is given twice")

    def get(self, name: str) -> Source:
        """The source; an unknown name is a KeyError."""
        return self._sources[name]

    def feeding(self, pipeline: str) -> list[Source]:
        return [s for s in self._sources.values() if pipeline in s.pipelines]

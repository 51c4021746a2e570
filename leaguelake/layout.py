"""Where tables live: ``{base}/{layer}/{source}/{entity}``, partitioned by run date ``dt``."""

from __future__ import annotations

from dataclasses import dataclass

RUN = "dt"


@dataclass(frozen=True)
class LakeLayout:
    base: str

    def table(self, layer: str, source: str, entity: str) -> str:
        return "/".join([self.base.rstrip("/"), layer, source, entity])

    def run(self, layer: str, source: str, entity: str, run_date: str) -> str:
        return f"{self.table(layer, source, entity)}/{RUN}={run_date}"

    def state(self, name: str) -> str:
        return "/".join([self.base.rstrip("/"), "metadata", name])

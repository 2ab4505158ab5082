"""Where a project's tables are: names of artefacts under one folder."""

from __future__ import annotations

from dataclasses import dataclass

#: Artefacts of a project by their folder; those of cell counting exist for tuning too.
FOLDERS = {
    "registration": ["ref", "annot", "ontology", "parameters", "transform", "downsampled_rough", "downsampled_fine", "trimmed", "bounded", "registered"],
    "mask": ["mask_fill", "mask_outline", "mask_code", "mask_regions"],
    "cellcount": ["raw", "overlap", "threshold_filtered", "maxima", "maxima_labels", "wshed_volumes", "wshed_filtered"],
    "analysis": ["cells_coords", "cells_raw", "cells_labels", "cells_trfm", "cells", "cells_agg", "cells_agg_csv"],
    "visual": ["points_raw", "heatmap_raw", "points_trfm", "heatmap_trfm", "maxima_final", "threshold_final", "wshed_final", "stack_registration", "stack_cells", "stack_points"],
}
_FOLDER = {name: folder for folder, names in FOLDERS.items() for name in names}


@dataclass(frozen=True)
class Project:
    root: str
    tuning: bool = False

    @property
    def config(self) -> str:
        return f"{self.root}/config"

    def path(self, name: str) -> str:
        if name not in _FOLDER:
            raise KeyError(f"no artefact is named {name}")
        folder = _FOLDER[name]
        return f"{self.root}/{folder}{'_tuning' * (self.tuning and folder in ('cellcount', 'analysis', 'visual'))}/{name}"

    def for_tuning(self) -> "Project":
        return Project(self.root, tuning=True)

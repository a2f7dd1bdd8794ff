from keyloom.sources.tables import as_frame, project_main, register_dimension, register_lookup

__all__ = ["as_frame", "project_main", "register_dimension", "register_lookup"]

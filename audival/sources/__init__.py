from audival.sources.tables import Tables

__all__ = ["Tables"]

from heldout.sources.tables import TABLES, labelled_documents, read_table

__all__ = ["TABLES", "labelled_documents", "read_table"]

from heldout.streaming.scoring import document_stream, score_document_stream

__all__ = ["document_stream", "score_document_stream"]

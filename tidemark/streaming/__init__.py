from tidemark.streaming.arrivals import clean_arrivals

__all__ = ["clean_arrivals"]

from starloom.streaming.late_feed import released_facts, release_waiting, start_late_feed

__all__ = ["release_waiting", "released_facts", "start_late_feed"]

from landfall.streaming.intake import (
    Intake,
    arrivals,
    notified_arrivals,
    pending_folders,
    start_intake,
    start_notified_intake,
)

__all__ = ["Intake", "arrivals", "notified_arrivals", "pending_folders", "start_intake", "start_notified_intake"]

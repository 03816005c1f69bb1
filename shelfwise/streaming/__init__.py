from shelfwise.streaming.incremental import (
    channel_days, latest_channel_days, latest_movements, moving_last_movement, run_available,
)

__all__ = ["channel_days", "latest_channel_days", "latest_movements", "moving_last_movement",
           "run_available"]

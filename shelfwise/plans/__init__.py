from shelfwise.plans.refresh import run_refresh, stage_all

__all__ = ["run_refresh", "stage_all"]

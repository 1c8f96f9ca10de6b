"""Errors of the control plane."""


class ContractError(ValueError):
    """A value breaks its contract."""


class PlanError(ContractError):
    """Stages do not make a plan."""


class ConflictError(RuntimeError):
    """A key is in use for something else."""


class CapacityError(RuntimeError):
    """No room for another run."""


class NotFoundError(KeyError):
    """Nothing has that id."""


class StageFailed(RuntimeError):
    def __init__(self, reason: str, detail: str = ""):
        super().__init__(f"{reason} {detail}".strip())
        self.reason = reason


class Cancelled(RuntimeError):
    """The run was cancelled."""

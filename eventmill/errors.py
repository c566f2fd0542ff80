"""Failures that stop a run."""


class MissingDayError(FileNotFoundError):
    """A requested day has no landed file."""


class SyncFailedError(RuntimeError):
    """At least one planned hour did not arrive."""


class QualityGateError(RuntimeError):
    """At least one day failed its pre-load checks."""

    def __init__(self, failures):
        self.failures = failures
        super().__init__(
            "; ".join(
                f"{f['land_date']} {f['check']}({f['column']}): {f['detail'] or _offenders(f)}" for f in failures
            )
        )


class StragglerError(RuntimeError):
    """A day's files hold rows of another day and the load is strict."""


class LoadMismatchError(RuntimeError):
    """The records counted before a load are not the rows it would store."""


class ConcurrentLoadError(RuntimeError):
    """Another load has claimed or changed a day since this one began."""


class ModelTestError(RuntimeError):
    """At least one model test found failing rows."""


def _offenders(failure: dict) -> str:
    shown = ", ".join(failure.get("partial_unexpected", ()))
    return f"{failure['unexpected_count']} of {failure['element_count']}" + (f", among them {shown}" if shown else "")

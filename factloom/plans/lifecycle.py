"""Control-plane rules as pure transitions: projection lifecycle, dead-letter actions, leases."""

from __future__ import annotations

from dataclasses import dataclass, replace


class Refused(ValueError):
    """A transition that the rules forbid; its text is the reason code."""


# Fixed values: (state, action) -> state.
TRANSITIONS = {
    ("MAPPING_CONTRACT_BLOCKED", "approve_definition"): "APPROVED_DISABLED",
    ("APPROVED_DISABLED", "set_shadow"): "SHADOW_READ_ONLY",
    ("SHADOW_READ_ONLY", "set_dry_run"): "DRY_RUN",
    ("DRY_RUN", "set_active"): "ACTIVE",
    ("ACTIVE", "suspend"): "SUSPENDED",
    ("SUSPENDED", "resume"): "SHADOW_READ_ONLY",
    ("BLOCKED_DRIFT", "resume"): "APPROVED_DISABLED",
    **{(s, "block_drift"): "BLOCKED_DRIFT" for s in ("APPROVED_DISABLED", "SHADOW_READ_ONLY", "DRY_RUN", "ACTIVE", "SUSPENDED")},
}


@dataclass(frozen=True)
class Lifecycle:
    projection: str
    state: str
    revision: int
    applied: tuple[tuple[str, str], ...] = ()  #: action id and content hash, in order


def apply(now: Lifecycle, action_id: str, action_hash: str, action: str, expected: int, may_activate: bool = False) -> Lifecycle:
    """The next state. A repeated action id is a no-op with equal content and refused with another."""
    for known, content in now.applied:
        if known == action_id:
            if content != action_hash:
                raise Refused("ACTION_CONTENT_CONFLICT")
            return now
    if expected != now.revision:
        raise Refused("REVISION_CONFLICT")
    target = TRANSITIONS.get((now.state, action))
    if target is None:
        raise Refused("PROJECTION_TRANSITION_FORBIDDEN")
    if target == "ACTIVE" and not may_activate:
        raise Refused("DOMAIN_PROJECTION_ACTIVATION_FORBIDDEN")
    return replace(now, state=target, revision=now.revision + 1, applied=(*now.applied, (action_id, action_hash)))


@dataclass(frozen=True)
class DeadLetter:
    scope: tuple[str, ...]
    status: str  #: open, retrying, resolved or ignored


def settle(row: DeadLetter, scope: tuple[str, ...], expected: str, action: str, terminal: bool = False, blocked: bool = False) -> DeadLetter:
    """Retry resolves only a terminal outcome that is not blocked; a settled letter stays as it is."""
    if row.scope != scope:
        raise Refused("DLQ_SCOPE_MISMATCH")
    goal = "ignored" if action == "ignore" else "resolved"
    if row.status == goal:
        return row
    if row.status != expected or row.status not in ("open", "retrying"):
        raise Refused("DLQ_STATUS_CONFLICT")
    if action == "retry" and not (terminal and not blocked):
        return replace(row, status="retrying")
    return replace(row, status=goal)


@dataclass(frozen=True)
class Lease:
    owner: str | None = None
    token: int = 0
    until: float = 0.0


def claim(lease: Lease, owner: str, now: float, seconds: float) -> Lease:
    if lease.owner is not None and now < lease.until:
        raise Refused("LEASE_HELD")
    return Lease(owner, lease.token + 1, now + seconds)


def renew(lease: Lease, owner: str, token: int, now: float, seconds: float) -> Lease:
    if (lease.owner, lease.token) != (owner, token) or now >= lease.until:
        raise Refused("LEASE_LOST")
    return replace(lease, until=now + seconds)


def release(lease: Lease, owner: str, token: int) -> Lease:
    if (lease.owner, lease.token) != (owner, token):
        raise Refused("LEASE_LOST")
    return replace(lease, owner=None, until=0.0)
